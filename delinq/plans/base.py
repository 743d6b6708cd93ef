"""Registration of queries, their fixed clock and the tables they share."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delinq import schemas
from delinq.operators import loans as loan_ops
from delinq.operators import master as master_ops
from delinq.operators import payments as pay_ops
from delinq.plans import jobs
from delinq.session import materialise
from delinq.sources import adapters


AS_OF = dt.date(2025, 1, 1)
AS_OF_TIME = dt.datetime(2025, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return add


def payment_rows_of(spark: SparkSession, d: str) -> DataFrame:
    """Payments without their own and their loan's key, written once: the joins behind them run once however often they are read."""
    return materialise(adapters.payments(spark, d).drop("payment_id", "loan_id"), "payments")


def master_of(spark: SparkSession, d: str, payments: DataFrame | None = None) -> DataFrame:
    payments = adapters.payments(spark, d) if payments is None else payments
    return master_ops.build_master(adapters.borrowers(spark, d), adapters.education(spark, d), adapters.loans(spark, d), payments)


def joined_of(spark: SparkSession, d: str) -> DataFrame:
    return master_ops.join_master(
        adapters.borrowers(spark, d),
        adapters.education(spark, d),
        pay_ops.delinquency_features(adapters.payments(spark, d)),
        adapters.loans(spark, d),
    )


def rule_scored_of(spark: SparkSession, d: str) -> DataFrame:
    return jobs.with_rule_scores(master_of(spark, d))


def outreach_of(spark: SparkSession, d: str) -> DataFrame:
    return jobs.outreach_table(rule_scored_of(spark, d), adapters.payments(spark, d), AS_OF_TIME)


def core_requests_of(spark: SparkSession, d: str) -> DataFrame:
    """Requests with the seven core fields, from borrowers and their loan totals."""
    summary = loan_ops.loan_summary(adapters.loans(spark, d))
    return adapters.borrowers(spark, d).join(summary, "borrower_id").select("borrower_id", *schemas.CORE_FIELDS)


def scored_docs_of(spark: SparkSession, d: str) -> DataFrame:
    docs = adapters.table(spark, d, "documents").select("doc_id", "n_chars")
    return adapters.table(spark, d, "labels").join(docs, "doc_id")


def time_text(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
