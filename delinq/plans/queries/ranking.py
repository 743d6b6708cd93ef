"""Registered queries: ranking metrics, split, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from delinq.functions.numeric import np_round
from delinq.operators import metrics, sampling
from delinq.operators import master as master_ops
from delinq.operators import outreach as out_ops
from delinq.operators import payments as pay_ops
from delinq.plans.base import master_of, outreach_of, register, scored_docs_of
from delinq.plans.check_sql import rounded, with_ctes
from delinq.session import materialise
from delinq.sources import adapters


_RANKED = """select score, pos, neg, sum(neg) over (order by score) - neg as neg_below,
    sum(pos) over (order by score) - pos as pos_below, sum(pos) over () as p, sum(neg) over () as n
  from (select n_chars as score, count(*) filter (where quality = 1) as pos, count(*) filter (where quality = 0) as neg
    from scored_docs group by 1)"""


@register(
    "e1_auc",
    with_ctes(
        f"select cast(sum(pos * (2 * neg_below + neg)) as double) / (cast(max(p) * max(n) as double) * 2) as roc_auc from ({_RANKED})",
        "scored_docs",
    ),
)
def _(spark, d):
    return metrics.roc_auc(scored_docs_of(spark, d), "n_chars", "quality")


@register(
    "e2_avg_precision",
    with_ctes(
        f"""select {rounded("sum(pos * ((p - pos_below) / (p - pos_below + n - neg_below))) / max(p)", 10)} as average_precision
        from ({_RANKED})""",
        "scored_docs",
    ),
)
def _(spark, d):
    out = metrics.average_precision(scored_docs_of(spark, d), "n_chars", "quality")
    return out.select(np_round(F.col("average_precision"), 10).alias("average_precision"))


@register("e3_split", with_ctes("select borrower_id, is_delinquent, split from split", "split"))
def _(spark, d):
    master = materialise(master_of(spark, d), "master")
    return sampling.stratified_split(master).select("borrower_id", "is_delinquent", "split")


@register(
    "e4_recent_trend",
    with_ctes(
        f"""select borrower_id, {rounded("avg(days_late)", 2)} as recent_trend, count(*) as payments_used
        from (select borrower_id, days_late,
            row_number() over (partition by borrower_id order by payment_date desc, payment_id desc) as r from payments)
        where r <= 6 group by 1""",
        "payments",
    ),
)
def _(spark, d):
    return pay_ops.last_payments_trend(adapters.payments(spark, d))


@register(
    "f3_first_of_segment",
    with_ctes("select _risk_segment, min(borrower_id) as first_borrower_id from borrowers group by 1", "borrowers"),
)
def _(spark, d):
    return master_ops.first_of_segment(adapters.borrowers(spark, d))


@register(
    "f3_first_ids",
    with_ctes("select borrower_id from master order by 1 limit 10", "master"),
)
def _(spark, d):
    return master_ops.first_ids(master_of(spark, d))


@register(
    "f4_work_list",
    with_ctes(
        "select * from high_risk order by priority_level, risk_score desc, borrower_id limit 50", "high_risk"
    ),
)
def _(spark, d):
    return out_ops.work_list(out_ops.high_risk(outreach_of(spark, d)), 50)
