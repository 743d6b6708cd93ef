"""From scored borrowers to the prioritised outreach list and its summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delinq import schemas
from delinq.functions.action import priority_level, recommended_action, total_owed
from delinq.functions.numeric import exact_avg, money_sum, np_round
from delinq.operators.payments import latest_activity


def with_loan_details(df: DataFrame, payments: DataFrame) -> DataFrame:
    """Add account id, balance, days past due, dates and amount owed.

    Days past due and the dates come from the payment table; a borrower without payments has
    0 days and no dates.
    """
    c = F.col
    out = df.join(latest_activity(payments), "borrower_id", "left")
    if "loan_id" not in df.columns:
        digits = F.regexp_extract("borrower_id", r"(\d+)$", 1)
        out = out.withColumn("loan_id", F.concat(F.lit("ML_"), F.lpad(digits, 8, "0")))
    balance = c("total_current_balance") if "total_current_balance" in df.columns else c("total_loan_amount") * 0.8
    return out.withColumns(
        {"current_balance": balance, "days_delinquent": F.coalesce(c("days_delinquent"), F.lit(0))}
    ).withColumn("total_owed", total_owed(c("current_balance"), c("days_delinquent")))


def with_actions(df: DataFrame) -> DataFrame:
    """Add recommended action and priority; without ``days_delinquent`` only the category counts."""
    days = F.col("days_delinquent") if "days_delinquent" in df.columns else F.lit(0)
    with_action = df.withColumn("recommended_action", recommended_action(days, F.col("risk_category")))
    return with_action.withColumn("priority_level", priority_level(F.col("recommended_action")))


def outreach_projection(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Contract columns that exist, in contract order, doubles rounded to cents."""
    stamped = df.withColumn("processing_date", F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")))
    columns: list[Column] = []
    for name in schemas.OUTREACH_COLUMNS:
        if name not in stamped.columns:
            continue
        is_float = isinstance(stamped.schema[name].dataType, (T.DoubleType, T.FloatType))
        columns.append(np_round(F.col(name), 2).alias(name) if is_float else F.col(name))
    return stamped.select(*columns)


def high_risk(outreach: DataFrame, min_risk_score: float = 50.0) -> DataFrame:
    """Rows with a rounded score at the floor, any day past due, or a high category."""
    # A filter drops unknown like false, so nulls need no care and the test reaches the scan.
    return outreach.filter(
        (F.col("risk_score") >= min_risk_score)
        | (F.col("days_delinquent") > 0)
        | F.col("risk_category").isin("High", "Critical")
    )


def work_list(outreach: DataFrame, n: int) -> DataFrame:
    """The n most urgent borrowers: priority, then score, then id."""
    return outreach.orderBy("priority_level", F.desc("risk_score"), "borrower_id").limit(n)


SUMMARY_FIELDS = ["risk_category", "priority_level", "recommended_action", "contact_preference", "state"]


def value_counts(df: DataFrame, fields: list[str] = SUMMARY_FIELDS) -> DataFrame:
    """Rows (field, value, count) for low-cardinality columns in one pass; nulls are left out."""
    present = [f for f in fields if f in df.columns]
    cells = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in present]
    tall = df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    return tall.groupBy("field", "value").agg(F.count(F.lit(1)).alias("count"))


def sorted_counts(df: DataFrame, field: str) -> DataFrame:
    """Rows per value of one column in key order; nulls are left out."""
    known = df.filter(F.col(field).isNotNull())
    return known.groupBy(field).agg(F.count(F.lit(1)).alias("count")).orderBy(field)


def _missing_cells(df: DataFrame) -> Column:
    per_row = sum((F.col(f"`{c}`").isNull().cast("int") for c in df.columns), F.lit(0))
    return F.coalesce(F.sum(per_row.cast("bigint")), F.lit(0))


def _completeness(df: DataFrame) -> Column:
    cells = F.count(F.lit(1)) * len(df.columns)
    return F.try_divide((cells - _missing_cells(df)).cast("double"), cells.cast("double"))


def completeness(df: DataFrame) -> DataFrame:
    """Share of filled cells and number of missing ones."""
    return df.agg(_completeness(df).alias("completeness"), _missing_cells(df).alias("missing_values"))


def summary_figures(outreach: DataFrame) -> DataFrame:
    """One row with the flat part of the summary, in one pass."""
    return outreach.agg(
        F.count(F.lit(1)).alias("total_borrowers"),
        exact_avg(F.col("risk_score"), 2).alias("average_risk_score"),
        F.count_if(F.col("days_delinquent") > 0).alias("delinquent_borrowers"),
        money_sum(F.col("total_owed")).alias("total_outstanding_balance"),
        exact_avg(F.col("total_owed"), 2).alias("average_outstanding_balance"),
        _completeness(outreach).alias("completeness"),
        _missing_cells(outreach).alias("missing_values"),
    )


def summary_report(outreach: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One nested row: figures, counts per value as maps, data quality."""
    counts = value_counts(outreach)

    def as_map(field: str) -> Column:
        entries = F.collect_list(F.when(F.col("field") == field, F.struct("value", "count")))
        return F.map_from_entries(F.array_sort(entries))

    names = {
        "risk_category": "risk_distribution",
        "priority_level": "action_priorities",
        "recommended_action": "recommended_actions",
        "contact_preference": "contact_preferences",
        "state": "state_distribution",
    }
    maps = counts.agg(F.struct(*[as_map(f).alias(out) for f, out in names.items()]).alias("m")).scalar()
    flat = summary_figures(outreach)
    return flat.select(
        F.lit(as_of.isoformat()).alias("processing_date"),
        "total_borrowers",
        "average_risk_score",
        "delinquent_borrowers",
        "total_outstanding_balance",
        "average_outstanding_balance",
        *[maps[out].alias(out) for out in names.values()],
        F.struct("completeness", "missing_values").alias("data_quality"),
    )


def short_summary(outreach: DataFrame) -> DataFrame:
    """Rows (metric, value) of the four headline figures as text."""
    figures = outreach.agg(
        F.count(F.lit(1)).cast("string").alias("n"),
        F.count_if(F.col("risk_category").isin("High", "Critical")).cast("string").alias("high"),
        F.format_string("%.2f", np_round(exact_avg(F.col("risk_score"), 2), 2)).alias("mean"),
        F.concat(F.lit("$"), F.format_number(money_sum(F.col("total_owed")), 2)).alias("owed"),
    )
    # Metric names.
    labels = {
        "Total Borrowers": "n",
        "High Risk Count": "high",
        "Average Risk Score": "mean",
        "Total Outstanding": "owed",
    }
    cells = [F.struct(F.lit(text).alias("metric"), F.col(col).alias("value")) for text, col in labels.items()]
    return figures.select(F.inline(F.array(*cells)))


def batch_summary(scored: DataFrame) -> DataFrame:
    """Records, High/Critical records and mean score of a scored batch."""
    return scored.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("risk_category").isin("High", "Critical")).alias("high_risk_count"),
        np_round(exact_avg(F.col("risk_score")), 4).alias("average_risk_score"),
    )
