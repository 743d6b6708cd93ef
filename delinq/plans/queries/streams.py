"""Registered queries: streams and their batch forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delinq import schemas
from delinq.functions import risk as K
from delinq.functions.numeric import np_round
from delinq.operators import requests
from delinq.operators import loans as loan_ops
from delinq.plans.base import register, time_text
from delinq.plans.check_sql import fallback, rounded, service_scale, with_ctes
from delinq.session import scratch_path
from delinq.sources import adapters
from delinq.streaming import metrics as stream_metrics
from delinq.streaming.scoring import read_stream, score_stream


def _score_by_rules(filled: DataFrame) -> DataFrame:
    """Stateless scoring of requests by the fallback rule."""
    p = K.fallback_probability(F.col("credit_score_at_origination"), F.col("debt_to_income_ratio"))
    full = requests.fill_request_defaults(filled)
    return full.select(
        "borrower_id", np_round(p, 9).alias("risk_probability"), K.service_category(p).alias("risk_category")
    )


_STREAM_P = fallback("credit_score_at_origination", "total_monthly_payment * 12 / nullif(annual_income, 0)")


@register(
    "j1_score_stream",
    with_ctes(
        f"""select borrower_id, {rounded(_STREAM_P, 9)} as risk_probability, {service_scale(_STREAM_P)} as risk_category
        from borrowers join loan_summary using (borrower_id)""",
        "borrowers",
        "loan_summary",
    ),
)
def _(spark, d):
    schema = adapters.table(spark, d, "customer").schema
    arriving = adapters.borrowers_from(read_stream(spark, d, schema, glob="customer.parquet"))
    summary = loan_ops.loan_summary(adapters.loans(spark, d))
    incoming = arriving.join(summary, "borrower_id").select("borrower_id", *schemas.CORE_FIELDS)
    output = scratch_path(spark, "scored")
    score_stream(incoming, _score_by_rules, output, scratch_path(spark, "state")).awaitTermination()
    return spark.read.parquet(output)


def _window_sql(starts: str) -> str:
    return f"""select strftime(s, '%Y-%m-%d %H:%M:%S') as window_start,
      strftime(s + interval 1 hour, '%Y-%m-%d %H:%M:%S') as window_end, event_type, count(*) as requests,
      count(*) filter (where event_type = 'error') as errors,
      {rounded("cast(sum(cast(value as decimal(18,4))) as double) / count(value)", 6)} as mean_value
    from ({starts}) group by s, event_type"""


_HOURS = "select date_trunc('hour', ts) as s, event_type, value from events"
_SLIDING = """select time_bucket(interval 30 minute, ts) - to_minutes(30 * b) as s, event_type, value
  from events cross join (select unnest([0, 1]) as b)"""


def _windows_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "window_start": time_text("window_start"),
            "window_end": time_text("window_end"),
            "mean_value": np_round(F.col("mean_value"), 6),
        }
    )


@register("j2_metric_windows", _window_sql(_HOURS))
def _(spark, d):
    return _windows_as_text(stream_metrics.window_metrics(adapters.table(spark, d, "events")))


@register("j2_sliding_windows", _window_sql(_SLIDING))
def _(spark, d):
    return _windows_as_text(stream_metrics.window_metrics(adapters.table(spark, d, "events"), slide="30 minutes"))


@register(
    "j2_sessions",
    """select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as session_start,
      strftime(max(ts) + interval 30 minute, '%Y-%m-%d %H:%M:%S') as session_end, count(*) as requests,
      count(*) filter (where event_type = 'error') as errors
    from (select *, sum(new) over (partition by user_id order by ts rows unbounded preceding) as session
      from (select *, case when ts < lag(ts) over (partition by user_id order by ts) + interval 30 minute then 0 else 1 end as new
        from events)) group by user_id, session""",
)
def _(spark, d):
    sessions = stream_metrics.session_metrics(adapters.table(spark, d, "events"))
    return sessions.withColumns({c: time_text(c) for c in ("session_start", "session_end")})


@register("j2_metric_stream", _window_sql(_HOURS))
def _(spark, d):
    schema = adapters.table(spark, d, "events").schema
    events = read_stream(spark, d, schema, glob="events.parquet")
    output = scratch_path(spark, "windows")
    stream_metrics.metrics_stream(
        events, stream_metrics.overwrite_table(output), scratch_path(spark, "state"), output_mode="complete"
    ).awaitTermination()
    return _windows_as_text(spark.read.parquet(output))


def _replay(spark, batches: list[DataFrame]) -> str:
    """A folder with one file a batch, written one after the other."""
    path = scratch_path(spark, "arriving")
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(path)
    return path


@register(
    "j2_late_events",
    """with sent as (select event_id, user_id, ts, event_id % 4 as batch, false as again from events
        union all select event_id, user_id, ts, event_id % 4 + 1, true from events where event_id % 50 = 0 and event_id % 4 < 3),
      behind as (select *, greatest(0, coalesce(epoch_us(max(ts) over (partition by user_id order by batch
          range between unbounded preceding and 1 preceding)) - epoch_us(ts), 0)) as delay_us from sent)
    select event_id, user_id, case when again then 'repeated' else 'late' end as kind, delay_us
    from behind where again or delay_us > 3600000000""",
)
def _(spark, d):
    """Events in four batches, some sent again: what comes late or twice, by user."""
    events = adapters.table(spark, d, "events")
    batch = F.col("event_id") % 4
    again = (F.col("event_id") % 50 == 0) & (batch < 3)
    path = _replay(spark, [events.where(batch == k).unionByName(events.where(again & (batch == k - 1))) for k in range(4)])
    output = scratch_path(spark, "odd")
    arriving = read_stream(spark, path, events.schema, files=1)
    stream_metrics.odd_events_stream(arriving, output, scratch_path(spark, "state"), keep="4000 days").awaitTermination()
    return spark.read.parquet(output)


@register(
    "j2_append_windows",
    f"""select * from ({_window_sql(_HOURS)})
    where strptime(window_end, '%Y-%m-%d %H:%M:%S') <= (select max(ts) - interval 1 hour from events)""",
)
def _(spark, d):
    """Windows in append mode, events in order of time: all but those the last watermark hasn't passed."""
    events = adapters.table(spark, d, "events")
    q1, q2, q3 = events.select(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), [0.25, 0.5, 0.75])).first()[0]
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    path = _replay(spark, [events.where((at > low) & (at <= high)) for low, high in ((-(1 << 62), q1), (q1, q2), (q2, q3), (q3, 1 << 62))])
    output = scratch_path(spark, "windows")
    arriving = read_stream(spark, path, events.schema, files=1)
    stream_metrics.metrics_stream(arriving, stream_metrics.batch_folders(output), scratch_path(spark, "state")).awaitTermination()
    return _windows_as_text(spark.read.parquet(output).drop("batch_id"))
