"""Request, error and value figures per time window and type."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from delinq.functions.numeric import exact_avg


def _event_time(events: DataFrame) -> DataFrame:
    """Watermarks need a timestamp with time zone; the supplied files have none.

    A column of the right type is left alone: a new one would lose its watermark.
    """
    if isinstance(events.schema["ts"].dataType, T.TimestampType):
        return events
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _figures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        exact_avg(F.col("value"), 4).alias("mean_value"),
    ]


def _bounded(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "event_type",
        "requests",
        "errors",
        "mean_value",
    )


def deduplicate(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """One row per event id; a stream keeps the ids of the watermark span only."""
    timed = _event_time(events)
    if timed.isStreaming:
        return timed.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["event_id"])
    return timed.dropDuplicates(["event_id"])


def window_metrics(events: DataFrame, width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Tumbling windows, or sliding ones with ``slide``; the same code for batch and stream.

    The aggregation is partial before the shuffle, so one busy type or hour is no hot spot.
    """
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    grouped = _event_time(events).groupBy(window.alias("window"), "event_type")
    return _bounded(grouped.agg(*_figures()))


def session_metrics(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Activity sessions per user, split by gaps without events.

    A stream uses the built-in session window. In batch, events are first merged per user and
    gap-wide time bin: two events of one bin are always less than a gap apart, so this loses
    nothing, and a user with any number of events shrinks to a few rows before the shuffle.
    """
    timed = _event_time(events)
    error = F.col("event_type") == "error"
    if timed.isStreaming:
        window = F.session_window("ts", f"{gap_minutes} minutes").alias("window")
        sums = timed.groupBy(window, "user_id").agg(
            F.count(F.lit(1)).alias("requests"), F.count_if(error).alias("errors")
        )
        return sums.select(
            "user_id",
            F.col("window.start").alias("session_start"),
            F.col("window.end").alias("session_end"),
            "requests",
            "errors",
        )
    gap = F.expr(f"interval {int(gap_minutes)} minutes")
    bins = timed.groupBy("user_id", F.window("ts", f"{gap_minutes} minutes").alias("bin")).agg(
        F.min("ts").alias("first"),
        F.max("ts").alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(error).alias("bad"),
    )
    order = Window.partitionBy("user_id").orderBy("first")
    starts = F.coalesce(F.col("first") >= F.lag("last").over(order) + gap, F.lit(True))
    numbered = bins.withColumn("new", starts.cast("int")).withColumn("session", F.sum("new").over(order))
    return numbered.groupBy("user_id", "session").agg(
        F.min("first").alias("session_start"),
        (F.max("last") + gap).alias("session_end"),
        F.sum("n").alias("requests"),
        F.sum("bad").alias("errors"),
    ).drop("session")


def metrics_stream(
    events: DataFrame,
    save: Callable[[DataFrame, int], None],
    checkpoint: str,
    width: str = "1 hour",
    slide: str | None = None,
    watermark: str = "1 hour",
    output_mode: str = "append",
    available_now: bool = True,
) -> StreamingQuery:
    """Windowed figures over deduplicated events.

    Append mode emits a window once the watermark has passed it and frees its state. ``save``
    gets (frame, batch id) and must be idempotent per batch id.
    """
    figures = window_metrics(deduplicate(events, watermark), width, slide)
    writer = figures.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(save)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


_ODD = "event_id bigint, user_id bigint, kind string, delay_us bigint"


def late_and_repeated(events: DataFrame, allowed_minutes: int = 60, keep: str = "30 days") -> DataFrame:
    """Stream of odd events: event_id, user_id, kind ("late", "repeated"), delay_us behind the user's newest event.

    Each user's state is the newest event time of earlier batches and the ids seen within ``keep`` of it. An event is
    repeated if its id was seen, and late if it is more than ``allowed_minutes`` older than the newest one; batches are
    taken as a whole, so the order inside one doesn't matter. A timer frees the state of a user whose newest event the
    watermark has left behind by ``keep``; events that old are dropped, as with any watermark.
    """
    keep_us = int(pd.Timedelta(keep).total_seconds() * 1e6)

    def odd(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        newest, ids, times = state.get if state.exists else (None, [], [])
        seen, top = dict(zip(ids, times)), newest
        for frame in frames:
            rows = []
            for event_id, at in zip(frame["event_id"].tolist(), frame["at"].tolist()):
                delay = 0 if newest is None else max(0, newest - at)
                if event_id in seen:
                    rows.append((event_id, key[0], "repeated", delay))
                elif delay > allowed_minutes * 60_000_000:
                    rows.append((event_id, key[0], "late", delay))
                seen.setdefault(event_id, at)
                top = at if top is None else max(top, at)
            yield pd.DataFrame(rows, columns=["event_id", "user_id", "kind", "delay_us"])
        held = [(i, t) for i, t in seen.items() if t >= top - keep_us]
        state.update((top, [i for i, _ in held], [t for _, t in held]))
        state.setTimeoutTimestamp(max(top + keep_us, state.getCurrentWatermarkMs() * 1000 + 1_000_000) // 1000)

    timed = _event_time(events).withWatermark("ts", keep).select("ts", "event_id", "user_id", F.unix_micros("ts").alias("at"))
    return timed.groupBy("user_id").applyInPandasWithState(
        odd, _ODD, "newest bigint, ids array<bigint>, times array<bigint>", "append", GroupStateTimeout.EventTimeTimeout
    )


def odd_events_stream(events: DataFrame, output: str, checkpoint: str, available_now: bool = True, **options) -> StreamingQuery:
    """``late_and_repeated`` into a parquet sink, every row exactly once."""
    writer = late_and_repeated(events, **options).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", output).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def overwrite_table(path: str):
    """Sink for complete mode: every batch replaces the whole result."""

    def save(frame: DataFrame, batch_id: int) -> None:
        frame.write.mode("overwrite").parquet(path)

    return save


def batch_folders(root: str):
    """Sink for append mode: one folder per batch, rewritten if the batch is replayed."""

    def save(frame: DataFrame, batch_id: int) -> None:
        frame.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return save
