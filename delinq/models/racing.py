"""Search over models and settings as a race: all run on the same folds, clear losers drop out after each.

A candidate is a model with one entry of its grid. After a fold every candidate is compared with the one that leads, fold by
fold: if the mean of the paired AUC differences is positive beyond its one-sided bound, the candidate is out. The
winner has run all folds, and so has everything that was not clearly worse.
"""

from __future__ import annotations

import json
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delinq import schemas
from delinq.models.training import (
    FULL_GRIDS,
    MODEL_NAMES,
    BalancedClassifier,
    RankingEvaluator,
    TrainedModel,
    make_classifier,
)
from delinq.operators.sampling import with_class_weights, with_folds
from delinq.session import materialise

#: One-sided 95 % points of Student's t for 1, 2, ... degrees of freedom; beyond them the normal one.
T_95 = [6.314, 2.920, 2.353, 2.132, 2.015, 1.943, 1.895, 1.860, 1.833, 1.812]
NORMAL_95 = 1.645


@dataclass
class Candidate:
    model: str
    setting: dict
    scores: list[float] = field(default_factory=list)
    dropped_after: int | None = None

    @property
    def mean(self) -> float:
        return sum(self.scores) / len(self.scores)


def candidates(names: list[str] = MODEL_NAMES, grids: dict[str, dict[str, list]] = FULL_GRIDS) -> list[Candidate]:
    """Every entry of the grids, models and settings in their given order."""
    return [
        Candidate(name, dict(zip(grids.get(name, {}), values)))
        for name in names
        for values in product(*grids.get(name, {}).values())
    ]


def clearly_worse(leader: list[float], other: list[float]) -> bool:
    """Whether the paired differences to the leader are positive beyond their bound; never from one fold."""
    gaps = [a - b for a, b in zip(leader, other)]
    m = len(gaps)
    if m < 2:
        return False
    mean = sum(gaps) / m
    spread = math.sqrt(sum((g - mean) ** 2 for g in gaps) / (m - 1) / m)
    t = T_95[m - 2] if m - 2 < len(T_95) else NORMAL_95
    return mean > 0 and mean > t * spread


@dataclass
class Race:
    entries: list[Candidate]
    winner: Candidate

    def table(self, spark: SparkSession) -> DataFrame:
        """model, setting (JSON), fold, auc, dropped_after (null: ran all folds), winner: a row a fit."""
        rows = [
            (c.model, json.dumps(c.setting, sort_keys=True), fold, score, c.dropped_after, c is self.winner)
            for c in self.entries
            for fold, score in enumerate(c.scores)
        ]
        return spark.createDataFrame(rows, "model string, setting string, fold int, auc double, dropped_after int, winner boolean")


def race(
    train: DataFrame,
    names: list[str] = MODEL_NAMES,
    grids: dict[str, dict[str, list]] = FULL_GRIDS,
    folds: int = 5,
    balance: str = "smote",
    params: dict[str, dict] | None = None,
    dropping: bool = True,
    parallelism: int = 2,
    seed: int = 42,
    label: str = schemas.TARGET,
) -> Race:
    """Run the race on rows (borrower_id, label, features); ``dropping=False`` is the full search on the same folds.

    ``params`` are settings a model has in every candidate. Each training part is balanced once and shared by all
    candidates; validation parts stay as they are.
    """
    if balance not in ("smote", "weights", "none"):
        raise ValueError(f"unknown balance {balance}")
    rows = materialise(with_folds(train, folds=folds, seed=seed), "folds")
    n = rows.count()
    entries = candidates(names, grids)
    judge = RankingEvaluator(label)
    for fold in range(folds):
        part = rows.where(F.col("fold") != fold).drop("fold")
        if balance == "smote":
            part = BalancedClassifier(make_classifier(names[0], label, seed), seed=seed).balanced(part)
        elif balance == "weights":
            part = materialise(with_class_weights(part, label), "weighted")
        held = rows.where(F.col("fold") == fold)

        def run(c: Candidate, fold=fold, part=part, held=held) -> float:
            setting = {**(params or {}).get(c.model, {}), **c.setting}
            if "C" in setting:  # the inverse penalty
                setting["regParam"] = 1.0 / (setting.pop("C") * n)
            classifier = make_classifier(c.model, label, seed, **setting)
            if balance == "weights":
                classifier.set(classifier.getParam("weightCol"), "weight")
            return judge.evaluate(classifier.fit(part).transform(held))

        running = [c for c in entries if c.dropped_after is None]
        with ThreadPoolExecutor(parallelism) as pool:
            for c, score in zip(running, pool.map(run, running)):
                c.scores.append(score)
        leader = max(running, key=lambda c: c.mean)  # the first of equals
        if dropping and fold + 1 < folds:
            for c in running:
                if c is not leader and clearly_worse(leader.scores, c.scores):
                    c.dropped_after = fold
    return Race(entries, max((c for c in entries if c.dropped_after is None), key=lambda c: c.mean))


def train_winner(train: DataFrame, won: Race, balance: str = "smote", params: dict[str, dict] | None = None, seed: int = 42, label: str = schemas.TARGET) -> TrainedModel:
    """The winner fitted on all rows."""
    c = won.winner
    setting = {**(params or {}).get(c.model, {}), **c.setting}
    if "C" in setting:
        setting["regParam"] = 1.0 / (setting.pop("C") * train.count())
    classifier = make_classifier(c.model, label, seed, **setting)
    rows, estimator = train, classifier
    if balance == "weights":
        rows = with_class_weights(train, label)
        classifier.set(classifier.getParam("weightCol"), "weight")
    elif balance == "smote":
        estimator = BalancedClassifier(classifier, seed=seed)
    return TrainedModel(c.model, estimator.fit(rows), dict(c.setting), c.mean)
