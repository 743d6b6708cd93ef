"""The four classifiers, their grids, cross-validated training and comparison."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delinq import schemas
from delinq.models.oversample import oversample_minority
from delinq.models.second_order import SecondOrderBooster
from delinq.operators.metrics import class_metrics, rank_models, ranking_metrics, roc_auc
from delinq.operators.sampling import with_class_weights, with_folds
from delinq.session import materialise

# Model names in training order and their full grids. A depth of 30 is the
# engine's maximum and stands for "unlimited".
MODEL_NAMES = ["logistic_regression", "random_forest", "gradient_boosting", "xgboost"]
FULL_GRIDS: dict[str, dict[str, list]] = {
    "logistic_regression": {"C": [0.1, 1.0, 10.0], "elasticNetParam": [1.0, 0.0]},
    "random_forest": {
        "numTrees": [100, 200, 300],
        "maxDepth": [10, 20, 30],
        "minInstancesPerNode": [1, 2, 4],
    },
    "gradient_boosting": {"maxIter": [100, 200], "stepSize": [0.05, 0.1, 0.2], "maxDepth": [3, 5, 7]},
    "xgboost": {
        "maxIter": [100, 200],
        "stepSize": [0.05, 0.1, 0.2],
        "maxDepth": [3, 5, 7],
        "subsamplingRate": [0.8, 1.0],
    },
}
# A first look at moderate cost: two settings per model.
SMALL_GRIDS: dict[str, dict[str, list]] = {
    "logistic_regression": {"C": [0.1, 1.0]},
    "random_forest": {"maxDepth": [5, 10]},
    "gradient_boosting": {"maxDepth": [3, 5]},
    "xgboost": {"maxDepth": [3, 5]},
}


def make_classifier(name: str, label: str = schemas.TARGET, seed: int = 42, **params) -> Estimator:
    """An untrained classifier; ``params`` override its defaults."""
    common = {"labelCol": label, "featuresCol": "features"}
    if name == "logistic_regression":
        return LogisticRegression(**common, **{"maxIter": 100, "standardization": False, **params})
    if name == "random_forest":
        return RandomForestClassifier(**common, seed=seed, **{"numTrees": 100, "maxDepth": 10, **params})
    if name == "gradient_boosting":
        return GBTClassifier(**common, seed=seed, **{"maxIter": 100, "stepSize": 0.1, "maxDepth": 3, **params})
    if name == "xgboost":
        # Second-order boosting of this library; the external one is not required.
        defaults = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 3, "subsamplingRate": 0.8}
        return SecondOrderBooster(**common, seed=seed, **{**defaults, **params})
    raise ValueError(f"unknown model {name}")


def param_grid(classifier: Estimator, settings: dict[str, list], n_rows: int) -> list[dict]:
    """Grid of parameter maps; the inverse penalty C becomes regParam = 1 / (C * n)."""
    builder = ParamGridBuilder()
    for name, values in settings.items():
        if name == "C":
            builder.addGrid(classifier.getParam("regParam"), [1.0 / (c * n_rows) for c in values])
        else:
            builder.addGrid(classifier.getParam(name), values)
    return builder.build()


class RankingEvaluator(Evaluator):
    """Exact ROC AUC of the positive class probability."""

    def __init__(self, label: str = schemas.TARGET):
        super().__init__()
        self.label = label

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = with_probability(dataset).select(self.label, "risk_probability")
        scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            value = roc_auc(scored, "risk_probability", self.label).first()["roc_auc"]
        finally:
            scored.unpersist()
        return 0.5 if value is None else value

    def isLargerBetter(self) -> bool:
        return True


class BalancedClassifier(Estimator):
    """A classifier that oversamples the minority of its training rows, and only of those.

    Validation folds stay untouched, and a parameter search oversamples each fold once.
    """

    def __init__(self, classifier: Estimator, k: int = 5, seed: int = 42):
        super().__init__()
        self.classifier, self.k, self.seed = classifier, k, seed

    def copy(self, extra=None):
        return BalancedClassifier(self.classifier.copy(extra or {}), self.k, self.seed)

    def balanced(self, dataset: DataFrame) -> DataFrame:
        """The rows with new ones of the minority, written once."""
        balanced = oversample_minority(dataset, label=self.classifier.getLabelCol(), k=self.k, seed=self.seed)
        return materialise(balanced, "balanced")

    def _fit(self, dataset: DataFrame) -> Model:
        return self.classifier.fit(self.balanced(dataset))

    def fitMultiple(self, dataset: DataFrame, paramMaps):
        balanced = self.balanced(dataset)
        models = enumerate(self.classifier.fit(balanced, pm) for pm in paramMaps)
        return iter(list(models))


def with_probability(predicted: DataFrame, column: str = "probability", output: str = "risk_probability") -> DataFrame:
    """Probability of class 1 as a double."""
    return predicted.withColumn(output, vector_to_array(column)[1])


@dataclass
class TrainedModel:
    name: str
    model: Model
    params: dict[str, float] = field(default_factory=dict)
    cv_score: float | None = None
    metrics: dict[str, float] = field(default_factory=dict)


def train_model(
    train: DataFrame,
    name: str,
    grid: dict[str, list] | None = None,
    folds: int = 5,
    balance: str = "smote",
    parallelism: int = 2,
    seed: int = 42,
    label: str = schemas.TARGET,
    **params,
) -> TrainedModel:
    """Train one model on rows (borrower_id, label, features).

    With a ``grid`` the best setting by cross-validated AUC is refitted on all rows; an empty
    grid only adds the cross-validated score; ``None`` trains once. ``balance`` is "smote",
    "weights" (no new rows, linear cost: the choice for very large minorities) or "none".
    """
    if balance not in ("smote", "weights", "none"):
        raise ValueError(f"unknown balance {balance}")
    classifier = make_classifier(name, label, seed, **params)
    rows = train
    if balance == "weights":
        rows = with_class_weights(train, label)
        classifier.set(classifier.getParam("weightCol"), "weight")
    estimator = BalancedClassifier(classifier, seed=seed) if balance == "smote" else classifier
    if grid is None:
        return TrainedModel(name, estimator.fit(rows))
    folded = materialise(with_folds(rows, folds=folds, seed=seed), "folds")
    maps = param_grid(classifier, grid, folded.count())
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=maps,
        evaluator=RankingEvaluator(label),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=seed,
    )
    fitted = search.fit(folded)
    best = max(range(len(maps)), key=lambda i: fitted.avgMetrics[i])
    chosen = {param.name: value for param, value in maps[best].items()}
    return TrainedModel(name, fitted.bestModel, chosen, fitted.avgMetrics[best])


def evaluate(model: Model, test: DataFrame, label: str = schemas.TARGET) -> dict[str, float]:
    """AUC, average precision, and precision, recall, F1, accuracy of class 1."""
    scored = with_probability(model.transform(test)).select(label, "prediction", "risk_probability")
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ranks = ranking_metrics(scored, "risk_probability", label).first().asDict()
        classes = class_metrics(scored, "prediction", label).drop("tp", "fp", "fn", "tn").first().asDict()
    finally:
        scored.unpersist()
    return {**ranks, **classes}


@dataclass
class ModelSet:
    """Trained models in training order with the best one named."""

    models: dict[str, TrainedModel]
    feature_names: list[str]
    best_name: str | None = None
    #: Names that were asked for and are not in the set, with the reason.
    failed: dict[str, str] = field(default_factory=dict)

    @property
    def best(self) -> TrainedModel:
        if self.best_name is None:
            raise ValueError("no model has a positive F1 score")
        return self.models[self.best_name]

    def metric_table(self, spark: SparkSession) -> DataFrame:
        """One row per model: position and test metrics."""
        names = ["test_auc", "test_avg_precision", "test_precision", "test_recall", "test_f1", "test_accuracy"]
        rows = [
            (name, i, *[m.metrics.get(x) for x in names]) for i, (name, m) in enumerate(self.models.items())
        ]
        columns = ", ".join(f"{n} double" for n in names)
        return spark.createDataFrame(rows, f"model string, position int, {columns}")


def train_all(
    train: DataFrame,
    test: DataFrame,
    feature_names: list[str],
    grids: dict[str, dict[str, list]] | None = None,
    names: list[str] = MODEL_NAMES,
    params: dict[str, dict] | None = None,
    skip_failing: bool = False,
    **options,
) -> ModelSet:
    """Train and evaluate all models. One that fails is an error: a set without it would pass for the whole comparison.

    A name that is no model is skipped with a warning and named in the set's ``failed``, and with ``skip_failing`` so is
    a model that fails.
    """
    trained: dict[str, TrainedModel] = {}
    failed: dict[str, str] = {}
    for name in names:
        try:
            grid = None if grids is None else grids.get(name)
            result = train_model(train, name, grid, **options, **(params or {}).get(name, {}))
            result.metrics = evaluate(result.model, test)
            trained[name] = result
        except Exception as error:  # noqa: BLE001 - where asked for, one failing model must not stop the others
            if name in MODEL_NAMES and not skip_failing:
                raise RuntimeError(f"{name} failed: {error}") from error
            warnings.warn(f"{name} skipped: {error}", stacklevel=2)
            failed[name] = str(error)
    out = ModelSet(trained, feature_names, failed=failed)
    if trained:
        best = rank_models(out.metric_table(train.sparkSession)).first()
        out.best_name = best["model"] if best else None
    return out


def feature_importance(trained: TrainedModel, feature_names: list[str], spark: SparkSession) -> DataFrame:
    """Rows (feature, importance), largest first: tree importance or absolute coefficient."""
    model = trained.model
    if hasattr(model, "featureImportances"):  # trees of all three kinds
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        values = abs(model.coefficients.toArray())
    else:
        raise ValueError(f"no importance for {type(model).__name__}")
    rows = [(n, float(v)) for n, v in zip(feature_names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def top_features(trained: TrainedModel, feature_names: list[str], spark: SparkSession, n: int = 20) -> DataFrame:
    return feature_importance(trained, feature_names, spark).limit(n)
