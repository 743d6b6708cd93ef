"""Save and load a model set with its preprocessing."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from delinq.models.training import ModelSet, TrainedModel
from delinq.operators.preprocess import FeatureModel


def save_models(spark: SparkSession, models: ModelSet, features: FeatureModel, root: str) -> None:
    """Each model under its name, metadata and preprocessing as small text tables."""
    for name, trained in models.models.items():
        PipelineModel([trained.model]).write().overwrite().save(f"{root}/{name}")
    meta = {
        "best_model_name": models.best_name,
        "feature_names": models.feature_names,
        "model_scores": {
            name: {"params": m.params, "cv_score": m.cv_score, "metrics": m.metrics}
            for name, m in models.models.items()
        },
        "failed": models.failed,
    }
    spark.range(1).select(F.lit(json.dumps(meta)).alias("value")).write.mode("overwrite").text(f"{root}/metadata")
    features.save(spark, f"{root}/preprocessing")


def load_models(spark: SparkSession, root: str) -> tuple[ModelSet, FeatureModel]:
    meta = json.loads(spark.read.text(f"{root}/metadata", wholetext=True).first()["value"])
    models = {
        name: TrainedModel(name, PipelineModel.load(f"{root}/{name}").stages[0], **state)
        for name, state in meta["model_scores"].items()
    }
    out = ModelSet(models, meta["feature_names"], meta["best_model_name"], meta.get("failed", {}))
    return out, FeatureModel.load(spark, f"{root}/preprocessing")
