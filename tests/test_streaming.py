from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from delinq import schemas
from delinq.models import scoring
from delinq.plans import jobs
from delinq.plans.queries.streams import _score_by_rules
from delinq.streaming import metrics as stream_metrics
from delinq.streaming.scoring import model_scorer, read_stream, score_stream

AS_OF = dt.datetime(2025, 1, 1)


def as_rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def request_files(domain, tmp_path):
    requests = domain["master"].select("borrower_id", *schemas.CORE_FIELDS)
    path = str(tmp_path / "requests")
    requests.repartition(4).write.parquet(path)
    return path, requests


def test_rule_stream_equals_batch(spark, request_files, tmp_path):
    path, requests = request_files
    stream = read_stream(spark, path, requests.schema)
    score_stream(stream, _score_by_rules, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert as_rows(spark.read.parquet(str(tmp_path / "out"))) == as_rows(_score_by_rules(requests))


def test_model_stream_equals_batch_and_resumes(spark, domain, request_files, tmp_path):
    path, requests = request_files
    models, features = jobs.train_from_master(
        domain["master"], AS_OF.date(), names=["logistic_regression"], params={"logistic_regression": {"maxIter": 5}}, balance="none"
    )
    scorer = model_scorer(models, features, AS_OF)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    score_stream(read_stream(spark, path, requests.schema), scorer, out, state).awaitTermination()
    requests.limit(3).write.mode("append").parquet(path)
    score_stream(read_stream(spark, path, requests.schema), scorer, out, state).awaitTermination()
    # Files of the first run are not scored again.
    assert spark.read.parquet(out).count() == requests.count() + 3
    batch = scoring.predict_all(requests, models, features, AS_OF)
    columns = ["borrower_id", "risk_assessment", "model_used", "error"]
    assert set(as_rows(spark.read.parquet(out).select(columns))) == set(as_rows(batch.select(columns)))


EVENT = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event(i, minute, kind="view", user=1, value=1.0):
    return (i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute), user, kind, value, "{}")


def test_late_and_duplicate_events(spark, tmp_path):
    """A repeated event counts once; an event behind the watermark is left out of append mode."""
    path, sink, state = str(tmp_path / "events"), str(tmp_path / "sink"), str(tmp_path / "state")

    def feed(rows):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(path)
        events = read_stream(spark, path, spark.createDataFrame([], EVENT).schema)
        stream_metrics.metrics_stream(events, stream_metrics.batch_folders(sink), state, watermark="1 hour").awaitTermination()

    feed([event(1, 5), event(2, 10, "error"), event(2, 10, "error")])
    feed([event(3, 300)])
    feed([event(4, 20), event(3, 300), event(5, 600)])
    rows = {(r["window_start"].hour, r["event_type"]): r for r in spark.read.parquet(sink).collect()}
    assert rows[(0, "error")]["requests"] == 1 and rows[(0, "error")]["errors"] == 1
    assert rows[(0, "view")]["requests"] == 1  # event 4 came too late
    assert rows[(5, "view")]["requests"] == 1


def test_complete_mode_equals_batch(spark, small, tmp_path):
    batch_events = spark.read.parquet(f"{small}/events.parquet")
    events = read_stream(spark, small, batch_events.schema, glob="events.parquet")
    out = str(tmp_path / "out")
    stream_metrics.metrics_stream(
        events, stream_metrics.overwrite_table(out), str(tmp_path / "state"), output_mode="complete"
    ).awaitTermination()
    assert as_rows(spark.read.parquet(out)) == as_rows(stream_metrics.window_metrics(batch_events))


def test_sessions_equal_the_built_in_window(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    for gap in (30, 300):
        built_in = timed.groupBy(F.session_window("ts", f"{gap} minutes").alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
        want = sorted((r["user_id"], r["w"]["start"], r["w"]["end"], r["n"]) for r in built_in.collect())
        got = stream_metrics.session_metrics(events, gap).collect()
        assert sorted((r["user_id"], r["session_start"], r["session_end"], r["requests"]) for r in got) == want


def test_sessions_touching_at_the_gap_stay_apart(spark):
    rows = [event(1, 0), event(2, 29), event(3, 59), event(4, 60)]
    df = spark.createDataFrame(rows, EVENT)
    got = sorted((r["session_start"].minute + 60 * r["session_start"].hour, r["requests"]) for r in stream_metrics.session_metrics(df, 30).collect())
    assert got == [(0, 2), (59, 2)]


def test_late_and_repeated_events(spark, tmp_path):
    """Three batches; lateness counts from earlier batches only, and a timer frees idle users."""
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    day = 24 * 60
    batches = [
        [event(1, 0), event(2, 200), event(3, 0, user=2), event(3, 0, user=2)],  # twice in one batch
        [event(4, 100), event(5, 150), event(2, 200), event(6, 500)],  # 100 minutes behind, 50 behind, seen before
        [event(7, 499), event(8, 439), event(9, 40 * day, user=3)],  # 61 minutes behind; the last one moves the watermark
        [event(10, 40 * day, user=2)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(path)
    arriving = read_stream(spark, path, spark.read.parquet(path).schema, files=1)
    stream_metrics.odd_events_stream(arriving, out, state, keep="10 days").awaitTermination()
    minute = 60_000_000
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(
        [(3, 2, "repeated", 0), (4, 1, "late", 100 * minute), (2, 1, "repeated", 0), (8, 1, "late", 61 * minute)]
    )
