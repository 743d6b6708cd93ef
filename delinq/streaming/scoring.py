"""Score requests as they arrive, with the code of the batch job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from delinq.models.registry import latest
from delinq.models.scoring import predict_all
from delinq.models.training import ModelSet
from delinq.operators.preprocess import FeatureModel


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", glob: str | None = None, files: int | None = None
) -> DataFrame:
    """Files of a folder as a stream, oldest first; ``glob`` picks file names, ``files`` bounds those of a batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def model_scorer(models: ModelSet, features: FeatureModel, as_of: dt.datetime) -> Callable[[DataFrame], DataFrame]:
    return lambda requests: predict_all(requests, models, features, as_of)


def score_stream(
    requests: DataFrame, scorer: Callable[[DataFrame], DataFrame], output: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Stateless scoring into a parquet sink.

    The file sink with its checkpoint writes every record exactly once, also when executors or
    the driver are lost. ``available_now`` drains what is there in rate-limited batches and
    stops; otherwise the query runs on.
    """
    writer = (
        scorer(requests)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def score_stream_by_registry(
    requests: DataFrame, registry: str, output: str, checkpoint: str, as_of: dt.datetime, available_now: bool = True
) -> StreamingQuery:
    """Score by the newest published models, looked up anew for every micro-batch; records name their version.

    A batch is written under its number and replaces what an earlier try of it left, so each record is there once. A batch
    that is tried again after a newer version came is scored by that one as a whole.
    """

    def score(batch: DataFrame, number: int) -> None:
        scoring = latest(batch.sparkSession, registry)
        scored = predict_all(batch, scoring, scoring.features, as_of)
        scored.withColumn("model_version", F.lit(scoring.version)).write.mode("overwrite").parquet(f"{output}/batch={number}")

    writer = requests.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
