"""Published versions of scoring sets, read by running streams."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from delinq.models.scoring import ScoringSet

_ROW = "version long, state string"


def publish(spark: SparkSession, root: str, scoring: ScoringSet, version: int) -> None:
    """Add a version; an existing one is never replaced. Its one file appears when it is whole."""
    text = replace(scoring, version=str(version)).to_json()
    row = spark.range(1).select(F.lit(version).cast("long").alias("version"), F.lit(text).alias("state"))
    row.coalesce(1).write.mode("errorifexists").parquet(f"{root}/v{version:010d}")


def latest(spark: SparkSession, root: str) -> ScoringSet:
    """The highest published version."""
    best = spark.read.schema(_ROW).parquet(f"{root}/v*").agg(F.max(F.struct("version", "state")).alias("m")).first()["m"]
    if best is None:
        raise ValueError(f"no version in {root}")
    return ScoringSet.from_json(best["state"])
