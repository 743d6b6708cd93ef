"""Registered queries: aggregates, summaries and fitted statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delinq import schemas
from delinq.functions.numeric import np_round
from delinq.operators import metrics, portfolio, preprocess, sampling
from delinq.operators import loans as loan_ops
from delinq.operators import outreach as out_ops
from delinq.operators import payments as pay_ops
from delinq.plans.base import (
    AS_OF,
    AS_OF_TIME,
    master_of,
    outreach_of,
    register,
    rule_scored_of,
    scored_docs_of,
)
from delinq.plans.check_sql import mean, money, rounded, with_ctes
from delinq.session import materialise
from delinq.sources import adapters


@register("d1_payment_stats", with_ctes("select * from stats", "stats"))
def _(spark, d):
    return pay_ops.payment_stats(adapters.payments(spark, d))


@register("d2_recent_stats", with_ctes("select * from recent", "recent"))
def _(spark, d):
    return pay_ops.recent_stats(adapters.payments(spark, d))


@register("d3_features", with_ctes("select * from features", "features"))
def _(spark, d):
    return pay_ops.delinquency_features(adapters.payments(spark, d))


@register("d4_loan_summary", with_ctes("select * from loan_summary", "loan_summary"))
def _(spark, d):
    return loan_ops.loan_summary(adapters.loans(spark, d))


@register(
    "d5_portfolio",
    with_ctes(
        f"""select count(*) as borrowers, cast(sum(is_delinquent) as bigint) as delinquent,
          avg(is_delinquent) as delinquency_rate, {rounded(mean("risk_score"), 4)} as mean_risk_score from master""",
        "master",
    ),
)
def _(spark, d):
    return portfolio.portfolio_rates(master_of(spark, d))


@register(
    "d6_cohorts",
    with_ctes(
        """select count(*) filter (where credit_score_at_origination < 600) as low_credit_borrowers,
          avg(is_delinquent) filter (where credit_score_at_origination < 600) as low_credit_rate,
          count(*) filter (where debt_to_income_ratio > 0.25) as high_dti_borrowers,
          avg(is_delinquent) filter (where debt_to_income_ratio > 0.25) as high_dti_rate,
          count(*) filter (where employment_status = 'Unemployed') as unemployed_borrowers,
          avg(is_delinquent) filter (where employment_status = 'Unemployed') as unemployed_rate
        from master""",
        "master",
    ),
)
def _(spark, d):
    return portfolio.cohort_rates(master_of(spark, d))


@register(
    "d7_segments",
    with_ctes(
        """select _risk_segment, count(*) as borrowers, count(*) / (select count(*) from borrowers) as share
        from borrowers group by 1""",
        "borrowers",
    ),
)
def _(spark, d):
    return portfolio.segment_shares(adapters.borrowers(spark, d))


@register(
    "d8_value_counts",
    with_ctes(
        """select field, value, count(*) as count from (
          select 'risk_category' as field, risk_category as value from high_risk
          union all select 'priority_level', cast(priority_level as varchar) from high_risk
          union all select 'recommended_action', recommended_action from high_risk
          union all select 'state', state from high_risk) where value is not null group by 1, 2""",
        "high_risk",
    ),
)
def _(spark, d):
    return out_ops.value_counts(out_ops.high_risk(outreach_of(spark, d)))


_OUT_COLUMNS = (
    "borrower_id state loan_id current_balance days_delinquent risk_score risk_category delinquency_probability"
    " recommended_action priority_level last_payment_date next_due_date total_owed processing_date"
).split()
_GAPS = " + ".join(f"({c} is null)::int" for c in schemas.MASTER.names)


@register(
    "d9_completeness",
    with_ctes(
        f"""select (count(*) * 36 - sum({_GAPS})) / (count(*) * 36) as completeness,
          cast(sum({_GAPS}) as bigint) as missing_values from master""",
        "master",
    ),
)
def _(spark, d):
    return out_ops.completeness(master_of(spark, d))


_OUT_GAPS = " + ".join(f"({c} is null)::int" for c in _OUT_COLUMNS)


@register(
    "d10_summary",
    with_ctes(
        f"""select count(*) as total_borrowers, {money("risk_score")} / count(risk_score) as average_risk_score,
          count(*) filter (where days_delinquent > 0) as delinquent_borrowers,
          {money("total_owed")} as total_outstanding_balance, {money("total_owed")} / count(total_owed) as average_outstanding_balance,
          (count(*) * 14 - sum({_OUT_GAPS})) / (count(*) * 14) as completeness,
          cast(sum({_OUT_GAPS}) as bigint) as missing_values from high_risk""",
        "high_risk",
    ),
)
def _(spark, d):
    return out_ops.summary_figures(out_ops.high_risk(outreach_of(spark, d)))


def _map_sql(column: str) -> str:
    return f"""(select '{{' || string_agg('"' || k || '":' || n, ',' order by k) || '}}' from (
      select cast({column} as varchar) as k, count(*) as n from high_risk where {column} is not null group by 1))"""


@register(
    "d10_summary_report",
    with_ctes(
        f"""select '2025-01-01T00:00:00' as processing_date, count(*) as total_borrowers,
          {_map_sql("risk_category")} as risk_distribution, {_map_sql("priority_level")} as action_priorities,
          {_map_sql("recommended_action")} as recommended_actions, {_map_sql("state")} as state_distribution
        from high_risk""",
        "high_risk",
    ),
)
def _(spark, d):
    listed = materialise(out_ops.high_risk(outreach_of(spark, d)), "outreach")
    report = out_ops.summary_report(listed, AS_OF_TIME)
    maps = ["risk_distribution", "action_priorities", "recommended_actions", "state_distribution"]
    return report.select("processing_date", "total_borrowers", *[F.to_json(m).alias(m) for m in maps])


@register(
    "d11_short_summary",
    with_ctes(
        f"""select 'Total Borrowers' as metric, cast(count(*) as varchar) as value from high_risk
        union all select 'High Risk Count', cast(count(*) as varchar) from high_risk where risk_category in ('High', 'Critical')
        union all select 'Average Risk Score', format('{{:.2f}}', {rounded(f"{money('risk_score')} / count(risk_score)", 2)}) from high_risk
        union all select 'Total Outstanding', '$' || format('{{:,.2f}}', {money("total_owed")}) from high_risk""",
        "high_risk",
    ),
)
def _(spark, d):
    return out_ops.short_summary(out_ops.high_risk(outreach_of(spark, d)))


@register(
    "d12_batch_summary",
    with_ctes(
        f"""select count(*) as total_records, count(*) filter (where risk_category in ('High', 'Critical')) as high_risk_count,
          {rounded(mean("risk_score"), 4)} as average_risk_score from rule_scored""",
        "rule_scored",
    ),
)
def _(spark, d):
    return out_ops.batch_summary(rule_scored_of(spark, d))


@register(
    "d13_sql_risk",
    with_ctes(
        f"""select is_delinquent, count(*) as borrower_count, {rounded("avg(risk_score)", 6)} as avg_risk_score,
          {rounded("avg(total_loan_amount)", 4)} as avg_loan_amount from master group by 1""",
        "master",
    ),
)
def _(spark, d):
    return portfolio.risk_by_target(master_of(spark, d)).withColumns(
        {
            "avg_risk_score": np_round(F.col("avg_risk_score"), 6),
            "avg_loan_amount": np_round(F.col("avg_loan_amount"), 4),
        }
    )


@register(
    "d14_sql_payments",
    with_ctes(
        "select payment_status, count(*) as payment_count, avg(days_late) as avg_days_late from payments group by 1",
        "payments",
    ),
)
def _(spark, d):
    return pay_ops.payments_by_status(adapters.payments(spark, d))


def _fit_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


@register(
    "d15_impute",
    with_ctes(
        " union all ".join(
            [f"select '{c}' as column, median({c})::double as median, null::varchar as mode from master" for c in schemas.NUMERIC_FEATURES]
            + [
                f"""select '{c}', null, (select {c} from master where {c} is not null group by {c}
                  order by count(*) desc, {c} limit 1)"""
                for c in schemas.CATEGORICAL_FEATURES
            ]
        ),
        "master",
    ),
)
def _(spark, d):
    fitted = preprocess.fit_features(master_of(spark, d), AS_OF)
    rows = [(c, m, None) for c, m in fitted.medians.items()] + [(c, None, m) for c, m in fitted.modes.items()]
    return _fit_rows(spark, rows, "column string, median double, mode string")


@register(
    "d16_categories",
    with_ctes(
        " union all ".join(
            f"""select '{c}' as column, category,
              cast(row_number() over (order by category nulls last) - 1 as int) as position
            from (select distinct {c} as category from engineered)"""
            for c in preprocess.ENCODED_FEATURES
        ),
        "engineered",
    ),
)
def _(spark, d):
    base = preprocess.add_engineered(master_of(spark, d), AS_OF)
    return preprocess.category_positions(preprocess.category_counts(base, preprocess.ENCODED_FEATURES))


@register(
    "d17_scale",
    with_ctes(
        " union all ".join(
            f"""select '{c}' as column, {rounded(f"avg({c})", 4)} as mean, {rounded(f"stddev_pop({c})", 4)} as std from imputed"""
            for c in schemas.SCALED_FEATURES
        ),
        "imputed",
    ),
)
def _(spark, d):
    master = materialise(master_of(spark, d), "master")
    fitted = preprocess.fit_features(master, AS_OF)
    stats = preprocess.scaling_stats(fitted.impute(fitted.engineer(master)), schemas.SCALED_FEATURES)
    return stats.select("column", np_round(F.col("mean"), 4).alias("mean"), np_round(F.col("std"), 4).alias("std"))


@register(
    "d18_balance",
    with_ctes("select split, count(*) as samples, avg(is_delinquent) as positive_rate from split group by 1", "split"),
)
def _(spark, d):
    return sampling.class_balance(sampling.stratified_split(materialise(master_of(spark, d), "master")))


@register(
    "d19_class_metrics",
    with_ctes(
        """select tp, fp, fn, tn, coalesce(tp / nullif(tp + fp, 0), 0) as test_precision,
          coalesce(tp / nullif(tp + fn, 0), 0) as test_recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as test_f1,
          (tp + tn) / (tp + fp + fn + tn) as test_accuracy
        from (select count(*) filter (where n_chars > 1000 and quality = 1) as tp,
            count(*) filter (where n_chars > 1000 and quality <> 1) as fp,
            count(*) filter (where n_chars <= 1000 and quality = 1) as fn,
            count(*) filter (where n_chars <= 1000 and quality <> 1) as tn from scored_docs)""",
        "scored_docs",
    ),
)
def _(spark, d):
    called = scored_docs_of(spark, d).withColumn("prediction", (F.col("n_chars") > 1000).cast("int"))
    return metrics.class_metrics(called, "prediction", "quality")


@register(
    "d20_prediction_stats",
    with_ctes(
        f"""select risk_category, count(*) as predictions, {rounded(mean("risk_score"), 4)} as mean_risk_score
        from rule_scored group by 1""",
        "rule_scored",
    ),
)
def _(spark, d):
    return metrics.prediction_stats(rule_scored_of(spark, d))


@register(
    "d21_documented",
    with_ctes(
        f"""select borrower_id, {rounded("stddev_samp(days_late)", 2)} as payment_volatility, any_value(burden) as payment_burden_score,
          any_value(concentration) as loan_concentration
        from payments join (select borrower_id, {rounded("total_monthly_payment / nullif(annual_income / 12, 0)", 6)} as burden from master)
            using (borrower_id)
          join (select borrower_id, {rounded(f"max(loan_amount) / {money('loan_amount')}", 6)} as concentration from loans group by 1)
            using (borrower_id)
        group by 1""",
        "master",
    ),
)
def _(spark, d):
    volatility = pay_ops.payment_volatility(adapters.payments(spark, d))
    burden = portfolio.payment_burden(master_of(spark, d))
    concentration = loan_ops.loan_concentration(adapters.loans(spark, d))
    return volatility.join(burden, "borrower_id").join(concentration, "borrower_id")


@register(
    "d21_seasonal",
    with_ctes(
        f"""select cast(month(payment_date) as int) as month, {rounded("avg(days_late)", 4)} as avg_days_late,
          count(*) as payment_count from payments group by 1""",
        "payments",
    ),
)
def _(spark, d):
    return pay_ops.seasonal_lateness(adapters.payments(spark, d))


@register(
    "f2_priority_counts",
    with_ctes("select priority_level, count(*) as count from high_risk group by 1 order by 1", "high_risk"),
)
def _(spark, d):
    return out_ops.sorted_counts(out_ops.high_risk(outreach_of(spark, d)), "priority_level")
