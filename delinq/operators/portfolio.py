"""Portfolio, cohort and segment figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delinq import schemas
from delinq.functions.numeric import exact_avg, np_round


def portfolio_rates(master: DataFrame) -> DataFrame:
    """One row: borrowers, delinquent borrowers, delinquency rate, mean score."""
    return master.agg(
        F.count(F.lit(1)).alias("borrowers"),
        F.sum(F.col(schemas.TARGET).cast("bigint")).alias("delinquent"),
        F.avg(schemas.TARGET).alias("delinquency_rate"),
        np_round(exact_avg(F.col("risk_score")), 4).alias("mean_risk_score"),
    )


def table_counts(**tables: DataFrame) -> DataFrame:
    """Row count per named table, and the total."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    total = counts.agg(F.sum("row_count").alias("row_count")).select(F.lit("TOTAL").alias("table_name"), "row_count")
    return counts.unionByName(total)


def cohort_rates(master: DataFrame) -> DataFrame:
    """Delinquency of three risk cohorts in one pass; a cohort without members gives NULL."""
    c = F.col
    # Cohort definitions.
    cohorts = {
        "low_credit": c("credit_score_at_origination") < 600,
        "high_dti": c("debt_to_income_ratio") > 0.25,
        "unemployed": c("employment_status") == "Unemployed",
    }
    aggs = []
    for name, member in cohorts.items():
        aggs.append(F.count_if(member).alias(f"{name}_borrowers"))
        aggs.append(F.avg(F.when(member, c(schemas.TARGET))).alias(f"{name}_rate"))
    return master.agg(*aggs)


def segment_shares(borrowers: DataFrame) -> DataFrame:
    """Borrowers per risk segment and their share of all.

    The total comes from the per-segment counts, so the rows are counted once.
    """
    counts = borrowers.groupBy("_risk_segment").agg(F.count(F.lit(1)).alias("borrowers"))
    total = counts.agg(F.sum("borrowers")).scalar()
    return counts.withColumn("share", F.col("borrowers") / total)


def risk_by_target(master: DataFrame) -> DataFrame:
    """Risk distribution by target, in SQL over the master table."""
    return master.sparkSession.sql(
        """
        SELECT is_delinquent, COUNT(*) AS borrower_count, AVG(risk_score) AS avg_risk_score,
               AVG(total_loan_amount) AS avg_loan_amount
        FROM {master}
        GROUP BY is_delinquent
        """,
        master=master,
    )


def payment_burden(master: DataFrame) -> DataFrame:
    """Monthly payment over monthly income."""
    c = F.col
    burden = F.try_divide(c("total_monthly_payment"), c("annual_income") / 12)
    return master.select("borrower_id", np_round(burden, 6).alias("payment_burden_score"))
