"""Payment behaviour per borrower."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delinq.functions.numeric import money_sum, np_round, ratio
from delinq.functions.risk import behaviour_score, behaviour_target

MISSED = "Missed Payment"


def recency_cutoff(payments: DataFrame, months: int = 6) -> Column:
    """Scalar: the last payment date of the whole table minus some months (month ends clip).

    It is a scalar subquery, so it is computed once and reaches the scan as a plain value.
    """
    month_text = f"interval {int(months)} months"
    return payments.agg((F.max("payment_date") - F.expr(month_text)).alias("cutoff")).scalar()


def _stat_columns() -> list[Column]:
    c = F.col
    return [
        np_round(F.avg("days_late"), 2).alias("avg_days_late"),
        F.max("days_late").alias("max_days_late"),
        np_round(F.coalesce(F.stddev_samp("days_late"), F.lit(0.0)), 2).alias("std_days_late"),
        money_sum(c("actual_amount")).alias("total_payments_made"),
        F.count("actual_amount").alias("total_payment_count"),
        money_sum(c("scheduled_amount")).alias("total_scheduled"),
        F.count_if(c("payment_status") == MISSED).alias("missed_payment_count"),
    ]


def _ratio_columns() -> dict[str, Column]:
    c = F.col
    return {
        "payment_ratio": ratio(c("total_payments_made"), c("total_scheduled")),
        "missed_payment_rate": ratio(c("missed_payment_count"), c("total_payment_count")),
    }


def _recent_columns(recent: Column) -> list[Column]:
    days = F.when(recent, F.col("days_late"))
    return [
        np_round(F.avg(days), 2).alias("recent_avg_days_late"),
        F.count_if(recent & (F.col("payment_status") == MISSED)).alias("recent_missed_payments"),
    ]


def payment_stats(payments: DataFrame) -> DataFrame:
    """Lifetime statistics and ratios; the ratios use the rounded figures."""
    return payments.groupBy("borrower_id").agg(*_stat_columns()).withColumns(_ratio_columns())


def recent_stats(payments: DataFrame, months: int = 6) -> DataFrame:
    """Statistics of the last months before the newest payment; one row per borrower with any."""
    recent = payments.filter(F.col("payment_date") >= recency_cutoff(payments, months))
    return recent.groupBy("borrower_id").agg(*_recent_columns(F.lit(True)))


def delinquency_features(payments: DataFrame, months: int = 6) -> DataFrame:
    """Lifetime and recent statistics, behavioural target and score in one aggregation.

    The recent part is a conditional aggregate next to the lifetime one: one scan and one
    shuffle of partial sums instead of two aggregations and a join.
    """
    recent = F.col("payment_date") >= recency_cutoff(payments, months)
    stats = payments.groupBy("borrower_id").agg(*_stat_columns(), *_recent_columns(recent))
    c = F.col
    return (
        stats.withColumns(_ratio_columns())
        .withColumns(
            {
                "recent_avg_days_late": F.coalesce(c("recent_avg_days_late"), F.lit(0.0)),
                "recent_missed_payments": c("recent_missed_payments").cast("double"),
            }
        )
        .select(
            "borrower_id",
            "avg_days_late",
            "max_days_late",
            "std_days_late",
            "total_payments_made",
            "total_payment_count",
            "total_scheduled",
            "missed_payment_count",
            "payment_ratio",
            "missed_payment_rate",
            "recent_avg_days_late",
            "recent_missed_payments",
            behaviour_target(c("recent_missed_payments"), c("recent_avg_days_late"), c("max_days_late")).alias(
                "is_delinquent"
            ),
            behaviour_score(c("missed_payment_rate"), c("recent_avg_days_late"), c("max_days_late")).alias(
                "risk_score"
            ),
        )
    )


def last_payments_trend(payments: DataFrame, n: int = 6) -> DataFrame:
    """Mean days late of the last n payments of each borrower.

    The rank filter is applied per input partition before the shuffle (group limit), so at most
    n rows per borrower and partition travel, however many payments one borrower has.
    """
    newest = Window.partitionBy("borrower_id").orderBy(F.desc("payment_date"), F.desc("payment_id"))
    return (
        payments.select("borrower_id", "payment_date", "payment_id", "days_late")
        .withColumn("rank", F.row_number().over(newest))
        .filter(F.col("rank") <= n)
        .groupBy("borrower_id")
        .agg(np_round(F.avg("days_late"), 2).alias("recent_trend"), F.count(F.lit(1)).alias("payments_used"))
    )


def payment_volatility(payments: DataFrame) -> DataFrame:
    return payments.groupBy("borrower_id").agg(
        np_round(F.stddev_samp("days_late"), 2).alias("payment_volatility")
    )


def seasonal_lateness(payments: DataFrame) -> DataFrame:
    """Mean days late by calendar month."""
    return payments.groupBy(F.month("payment_date").alias("month")).agg(
        np_round(F.avg("days_late"), 4).alias("avg_days_late"),
        F.count(F.lit(1)).alias("payment_count"),
    )


def payments_by_status(payments: DataFrame) -> DataFrame:
    """Count and mean days late per payment status, in SQL over the payments table."""
    return payments.sparkSession.sql(
        """
        SELECT payment_status, COUNT(*) AS payment_count, AVG(days_late) AS avg_days_late
        FROM {payments}
        GROUP BY payment_status
        """,
        payments=payments,
    )


def latest_activity(payments: DataFrame, months: int = 6) -> DataFrame:
    """Per borrower: days past due, last date with money received, next due date.

    Days past due is the longest delay among the recent missed payments, 0 without one.
    """
    missed = (F.col("payment_date") >= recency_cutoff(payments, months)) & (F.col("payment_status") == MISSED)
    return payments.groupBy("borrower_id").agg(
        F.coalesce(F.max(F.when(missed, F.col("days_late"))), F.lit(0)).alias("days_delinquent"),
        F.date_format(
            F.max(F.when(F.col("actual_amount") > 0, F.col("payment_date"))), "yyyy-MM-dd"
        ).alias("last_payment_date"),
        F.date_format(F.add_months(F.max("payment_date").cast("date"), 1), "yyyy-MM-dd").alias("next_due_date"),
    )
