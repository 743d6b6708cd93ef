"""Apply trained models to borrowers and requests."""

from __future__ import annotations

import datetime as dt

import json
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delinq import schemas
from delinq.functions.response import prediction, prediction_map
from delinq.functions.risk import confidence_interval, model_category
from delinq.models.compiled import CompiledModel, compile_model
from delinq.models.training import ModelSet
from delinq.operators.preprocess import FeatureModel
from delinq.operators.requests import fill_request_defaults, with_request_errors

PRIMARY_MODEL = "random_forest"


@dataclass(frozen=True)
class ScoringSet:
    """Compiled models with their preprocessing, as one JSON text: all that scoring needs."""

    models: dict[str, CompiledModel]
    features: FeatureModel
    best_name: str | None
    version: str = "0"

    @staticmethod
    def of(spark: SparkSession, models: ModelSet, features: FeatureModel, version: str = "0") -> ScoringSet:
        compiled = {name: compile_model(spark, m.model) for name, m in models.models.items()}
        return ScoringSet(compiled, features, models.best_name, version)

    def to_json(self) -> str:
        models = {name: json.loads(m.to_json()) for name, m in self.models.items()}
        return json.dumps({"models": models, "features": self.features.to_json(), "best_name": self.best_name, "version": self.version})

    @staticmethod
    def from_json(text: str) -> ScoringSet:
        state = json.loads(text)
        models = {name: CompiledModel(**m) for name, m in state["models"].items()}
        return ScoringSet(models, FeatureModel.from_json(state["features"]), state["best_name"], state["version"])


def _best_name(models: ModelSet | ScoringSet) -> str:
    if models.best_name is None:
        raise ValueError("no model has a positive F1 score")
    return models.best_name


def _apply(df: DataFrame, models: ModelSet | ScoringSet, names: list[str]) -> DataFrame:
    """Chain the models over the same rows; each leaves ``p_<name>`` and ``c_<name>``."""
    if isinstance(models, ScoringSet):
        out = df.withColumns({f"p_{n}": models.models[n].probability(F.col("features")) for n in names})
        return out.withColumns({f"c_{n}": (F.col(f"p_{n}") > 0.5).cast("double") for n in names})
    out = df
    for name in names:
        model = models.models[name].model.copy()
        model.setPredictionCol(f"c_{name}").setProbabilityCol(f"_prob_{name}").setRawPredictionCol(f"_raw_{name}")
        out = model.transform(out)
        out = out.withColumn(f"p_{name}", vector_to_array(f"_prob_{name}")[1]).drop(f"_prob_{name}", f"_raw_{name}")
    return out


def _with_features(df: DataFrame, models: ModelSet | ScoringSet, features: FeatureModel) -> DataFrame:
    """All input columns in ``_row`` and ``features``, a vector or for compiled models an array. Rows are never re-joined."""
    packed = df.withColumn("_row", F.struct(*[F.col(c) for c in df.columns]))
    if isinstance(models, ScoringSet):
        wide = features.transform(packed, keep=["_row"])
        return wide.select("_row", F.array(*[F.col(f"`{n}`") for n in features.feature_names]).alias("features"))
    return features.assemble(packed, keep=["_row"])


def predict(
    df: DataFrame, models: ModelSet | ScoringSet, features: FeatureModel, name: str | None = None
) -> DataFrame:
    """Input columns plus probability, 0/1 prediction and category of the best or a named model."""
    name = name or _best_name(models)
    if name not in models.models:
        raise ValueError(f"Model {name} not found or not trained.")
    scored = _apply(_with_features(df, models, features), models, [name])
    own = [c for c in df.columns if c not in ("risk_score", "risk_probability", "risk_prediction", "risk_category")]
    p = F.col(f"p_{name}")
    return scored.select(
        *[F.col("_row")[c].alias(c) for c in own],
        p.alias("risk_probability"),
        F.col(f"c_{name}").cast("int").alias("risk_prediction"),
        model_category(p).alias("risk_category"),
        (p * 100).alias("risk_score"),
    )


def predict_all(
    requests: DataFrame, models: ModelSet | ScoringSet, features: FeatureModel, as_of: dt.datetime
) -> DataFrame:
    """Score requests with every model; bad requests come back as error records.

    The primary model answers; where it is missing the first trained one does.
    """
    checked = with_request_errors(requests)
    names = list(models.models)
    scored = _apply(_with_features(fill_request_defaults(checked), models, features), models, names)
    good = F.col("_row")["error"].isNull()
    probabilities: dict[str, Column] = {n: F.when(good, F.col(f"p_{n}")) for n in names}
    answer_order = [n for n in [PRIMARY_MODEL] if n in names] + [n for n in names if n != PRIMARY_MODEL]
    answer = F.coalesce(*[probabilities[n] for n in answer_order])
    used = F.coalesce(*[F.when(probabilities[n].isNotNull(), F.lit(n)) for n in answer_order])
    return scored.select(
        F.coalesce(F.col("_row")["borrower_id"], F.lit("UNKNOWN")).alias("borrower_id"),
        prediction(answer).alias("risk_assessment"),
        prediction_map(probabilities).alias("all_model_predictions"),
        used.alias("model_used"),
        F.lit(as_of.isoformat()).alias("prediction_timestamp"),
        F.col("_row")["error"].alias("error"),
        F.col("_row")["error_type"].alias("error_type"),
    )


def batch_records(
    df: DataFrame, models: ModelSet | ScoringSet, features: FeatureModel, as_of: dt.datetime
) -> DataFrame:
    """Flat prediction records of a batch with confidence interval and model version."""
    scored = predict(df, models, features)
    interval = confidence_interval(F.col("risk_probability"))
    return scored.select(
        F.coalesce("borrower_id", F.lit("UNKNOWN")).alias("borrower_id"),
        "risk_probability",
        "risk_prediction",
        "risk_category",
        "risk_score",
        F.lit(as_of.isoformat()).alias("prediction_timestamp"),
        F.lit(_best_name(models)).alias("model_version"),
        interval["lower_bound"].alias("lower_bound"),
        interval["upper_bound"].alias("upper_bound"),
    )


def training_frame(split: DataFrame, features: FeatureModel) -> tuple[DataFrame, DataFrame]:
    """Train and test rows (borrower_id, target, features) from a split master table.

    A part is cut before its features are worked out: Spark does not move a filter below the assembler.
    """
    train, test = (
        features.assemble(split.filter(F.col("split") == part), keep=["borrower_id", schemas.TARGET]) for part in ("train", "test")
    )
    return train, test
