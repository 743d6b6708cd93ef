"""Loan aggregates and schedules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delinq.functions.numeric import exact_avg, money_sum, np_round, ratio


def loan_summary(loans: DataFrame) -> DataFrame:
    """Amounts, count, mean rate and payment burden per borrower."""
    c = F.col
    return loans.groupBy("borrower_id").agg(
        money_sum(c("loan_amount")).alias("total_loan_amount"),
        F.count("loan_amount").alias("loan_count"),
        np_round(exact_avg(c("loan_amount"), 2), 2).alias("avg_loan_amount"),
        np_round(exact_avg(c("interest_rate")), 2).alias("avg_interest_rate"),
        money_sum(c("current_balance")).alias("total_current_balance"),
        money_sum(c("monthly_payment")).alias("total_monthly_payment"),
    )


def payment_schedule(loans: DataFrame, months: int = 24) -> DataFrame:
    """One row per loan and month: due date with month ends clipped, and the amount due."""
    return loans.select(
        "loan_id",
        "borrower_id",
        F.explode(F.sequence(F.lit(0), F.lit(int(months) - 1))).alias("month_offset"),
        "origination_date",
        F.col("monthly_payment").alias("scheduled_amount"),
    ).select(
        "loan_id",
        "borrower_id",
        "month_offset",
        (F.col("origination_date") + F.make_ym_interval(F.lit(0), F.col("month_offset"))).alias("due_date"),
        "scheduled_amount",
    )


def loan_concentration(loans: DataFrame) -> DataFrame:
    """Share of the largest loan in the total of each borrower."""
    return loans.groupBy("borrower_id").agg(
        np_round(ratio(F.max("loan_amount"), money_sum(F.col("loan_amount"))), 6).alias("loan_concentration")
    )
