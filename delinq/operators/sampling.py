"""Stratified split, folds and class balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delinq import schemas
from delinq.functions.numeric import uniform
from delinq.operators.ranking import pick_exactly


def stratified_split(
    df: DataFrame,
    key: str = "borrower_id",
    label: str = schemas.TARGET,
    test_size: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Add ``split`` = train/test with exactly round(test_size * n) test rows per class."""
    take = F.rint(F.col("_n") * F.lit(float(test_size))).cast("bigint")
    picked = pick_exactly(df, key, label, take, seed, output="_test")
    return picked.withColumn("split", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def with_folds(df: DataFrame, key: str = "borrower_id", folds: int = 5, seed: int = 42) -> DataFrame:
    """Add an integer fold from the hash of the key."""
    return df.withColumn("fold", F.floor(uniform(F.col(key), seed) * folds).cast("int"))


def class_balance(split: DataFrame, label: str = schemas.TARGET) -> DataFrame:
    """Rows and positive share of each part of a split."""
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("samples"), F.avg(label).alias("positive_rate"))


def with_class_weights(df: DataFrame, label: str = schemas.TARGET) -> DataFrame:
    """Weight every row so that both classes weigh the same in total."""
    counts = df.agg(
        F.struct(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.count_if(F.col(label) == 1).cast("double").alias("pos"),
        ).alias("c")
    ).scalar()
    own = F.when(F.col(label) == 1, counts["pos"]).otherwise(counts["n"] - counts["pos"])
    return df.withColumn("weight", counts["n"] / (own * 2))
