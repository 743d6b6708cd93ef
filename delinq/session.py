"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "delinq", **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    Cluster-wide sizing (executors, shuffle partitions) belongs to the deployment and is
    passed in as ``conf``; only semantics and adaptive execution are fixed here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for written intermediates, stream state and round trips.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Only in local mode, where
    one machine holds everything, a temporary folder stands in for an unset one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="delinq-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    It cuts the lineage of iterative jobs (every task would carry the whole plan otherwise) and
    survives the loss of executors, which cached blocks do not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
