from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from delinq import schemas
from delinq.models import racing, registry
from delinq.models.scoring import ScoringSet, predict_all
from delinq.plans import jobs
from delinq.streaming.scoring import read_stream, score_stream_by_registry

AS_OF = dt.datetime(2025, 1, 1)
LIGHT = {"logistic_regression": {"maxIter": 5}, "gradient_boosting": {"maxIter": 2, "maxDepth": 1}, "xgboost": {"maxIter": 4, "maxDepth": 2}}


def test_candidates_cover_the_full_grids():
    found = racing.candidates()
    assert len(found) == 6 + 27 + 18 + 36 and found[0].setting == {"C": 0.1, "elasticNetParam": 1.0}
    assert [c.setting for c in racing.candidates(["random_forest"], {})] == [{}]


def test_bound_is_paired():
    assert not racing.clearly_worse([0.9], [0.1])
    assert racing.clearly_worse([0.9, 0.8, 0.7], [0.8, 0.7, 0.6]) and racing.clearly_worse([0.9, 0.8, 0.7], [0.8, 0.71, 0.6])
    assert not racing.clearly_worse([0.9, 0.8, 0.7], [0.5, 0.79, 0.71]) and not racing.clearly_worse([0.5, 0.6], [0.5, 0.6])
    assert not racing.clearly_worse([0.5, 0.6, 0.5], [0.9, 0.9, 0.8])


def test_same_winner_as_the_full_search(spark):
    """A signal that only trees with two levels see: an exclusive or."""
    rng, rows = random.Random(5), []
    for i in range(600):
        x = [rng.random() for _ in range(3)]
        rows.append((f"B{i}", int(rng.random() < (0.9 if (x[0] > 0.4) != (x[1] > 0.6) else 0.1)), Vectors.dense(x)))
    df = spark.createDataFrame(rows, ["borrower_id", schemas.TARGET, "features"])
    grids = {"logistic_regression": {"C": [0.01, 1.0]}, "xgboost": {"stepSize": [0.001, 0.5]}}
    names = ["logistic_regression", "xgboost"]
    options = {"names": names, "grids": grids, "folds": 4, "balance": "none", "params": LIGHT}
    fast, full = racing.race(df, **options), racing.race(df, dropping=False, **options)
    assert (fast.winner.model, fast.winner.setting) == (full.winner.model, full.winner.setting) and fast.winner.model == "xgboost"
    assert all(len(c.scores) == 4 for c in full.entries)
    linear = [c for c in fast.entries if c.model == "logistic_regression"]
    assert all(c.dropped_after is not None and len(c.scores) == c.dropped_after + 1 for c in linear)
    for a, b in zip(fast.entries, full.entries):
        assert a.scores == pytest.approx(b.scores[: len(a.scores)])
    table = fast.table(spark)
    assert table.where("winner").select("setting").distinct().count() == 1 and table.count() == sum(len(c.scores) for c in fast.entries)
    trained = racing.train_winner(df, fast, balance="none", params=LIGHT)
    assert trained.name == "xgboost" and trained.cv_score == fast.winner.mean
    with pytest.raises(ValueError):
        racing.race(df, balance="other")


def test_new_version_applies_without_restart(spark, domain, tmp_path):
    """Two batches of one stream; between them a newer model set is published."""
    models, features = jobs.train_from_master(
        domain["master"], AS_OF.date(), params=LIGHT, balance="weights", names=["logistic_regression", "gradient_boosting"]
    )
    whole = ScoringSet.of(spark, models, features)
    assert ScoringSet.from_json(whole.to_json()) == whole
    first = ScoringSet({"logistic_regression": whole.models["logistic_regression"]}, features, "logistic_regression")
    second = ScoringSet({"gradient_boosting": whole.models["gradient_boosting"]}, features, "gradient_boosting")
    requests = domain["master"].select("borrower_id", *schemas.CORE_FIELDS).dropna().orderBy("borrower_id").limit(40)
    source, root, output = str(tmp_path / "in"), str(tmp_path / "registry"), str(tmp_path / "out")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|no version"):
        registry.latest(spark, root)
    registry.publish(spark, root, first, 1)

    def drain():
        arriving = read_stream(spark, source, requests.schema)
        score_stream_by_registry(arriving, root, output, str(tmp_path / "state"), AS_OF).awaitTermination()

    requests.limit(15).write.parquet(source)
    drain()
    registry.publish(spark, root, second, 2)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        registry.publish(spark, root, first, 2)
    requests.offset(15).write.mode("append").parquet(source)
    drain()
    rows = spark.read.parquet(output)
    assert {(r[0], r[1]): r[2] for r in rows.groupBy("model_version", "model_used").count().collect()} == {
        ("1", "logistic_regression"): 15, ("2", "gradient_boosting"): 25
    }
    want = predict_all(requests, second, features, AS_OF).select("borrower_id", F.col("risk_assessment").alias("want"))
    late = rows.where("model_version = '2'").join(want, "borrower_id")
    assert late.count() == 25 and late.where("risk_assessment <> want").count() == 0
