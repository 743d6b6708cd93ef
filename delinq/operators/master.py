"""The one-row-per-borrower master table, enrichment and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delinq import schemas
from delinq.functions.loan import debt_to_income
from delinq.functions.risk import delinquency_draw, delinquency_probability, factor_score
from delinq.operators.loans import loan_summary
from delinq.operators.payments import delinquency_features

KEY = "borrower_id"


def join_master(
    borrowers: DataFrame, education: DataFrame, features: DataFrame, loans: DataFrame
) -> DataFrame:
    """Inner join of the four sources on the borrower, with debt-to-income.

    Payments and loans are aggregated first, so the joins see one row per borrower and the two
    aggregated sides come already hash-partitioned by the join key.
    """
    joined = (
        borrowers.drop("_risk_segment")
        .join(education, KEY)
        .join(features, KEY)
        .join(loan_summary(loans), KEY)
    )
    c = F.col
    return joined.withColumn(
        "debt_to_income_ratio", debt_to_income(c("total_monthly_payment"), c("annual_income"))
    ).select(*schemas.MASTER.names)


def with_factor_targets(master: DataFrame, seed: int = 42) -> DataFrame:
    """Replace score and target by the multi-factor score and a repeatable sigmoid draw."""
    c = F.col
    scored = master.withColumn(
        "risk_score",
        factor_score(
            c("credit_score_at_origination"),
            c("debt_to_income_ratio"),
            c("missed_payment_rate"),
            c("recent_missed_payments"),
            c("employment_status"),
        ),
    )
    return scored.withColumn(schemas.TARGET, delinquency_draw(c(KEY), c("risk_score"), seed))


def with_probability(master: DataFrame) -> DataFrame:
    return master.withColumn("delinquency_probability", delinquency_probability(F.col("risk_score")))


def build_master(
    borrowers: DataFrame, education: DataFrame, loans: DataFrame, payments: DataFrame, seed: int = 42
) -> DataFrame:
    """Master table from the four source tables."""
    joined = join_master(borrowers, education, delinquency_features(payments), loans)
    return with_factor_targets(joined, seed)


def enrich_with_segment(master: DataFrame, borrowers: DataFrame) -> DataFrame:
    """Left join of the risk segment; borrowers without one stay."""
    return master.join(borrowers.select(KEY, "_risk_segment"), KEY, "left")


def lookup(master: DataFrame, ids: DataFrame) -> DataFrame:
    """The requested ids with their master row; an unknown id gives an error record."""
    hits = master.withColumn("found", F.lit(True))
    joined = ids.select(KEY).join(hits, KEY, "left")
    found = F.coalesce(F.col("found"), F.lit(False))
    error = F.when(~found, F.concat(F.lit("Borrower "), F.col(KEY), F.lit(" not found")))
    return joined.withColumns({"found": found, "error": error})


def lookup_one(master: DataFrame, borrower_id: str) -> DataFrame:
    """Point lookup; the filter reaches the scan of a stored master table."""
    return master.filter(F.col(KEY) == borrower_id)


def first_of_segment(enriched: DataFrame) -> DataFrame:
    """Smallest borrower id per risk segment."""
    return enriched.groupBy("_risk_segment").agg(F.min(KEY).alias("first_borrower_id"))


def first_ids(master: DataFrame, n: int = 10) -> DataFrame:
    return master.select(KEY).orderBy(KEY).limit(n)
