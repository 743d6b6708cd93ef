"""Registered queries: scans, sinks, catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delinq import schemas
from delinq.operators import portfolio
from delinq.operators import master as master_ops
from delinq.operators import payments as pay_ops
from delinq.operators.requests import request_faults
from delinq.plans.base import core_requests_of, outreach_of, register
from delinq.plans.check_sql import with_ctes
from delinq.session import materialise, scratch_path
from delinq.sources import adapters, catalog, files


_LOANS_AS_TEXT = """select loan_id, borrower_id, loan_amount,
  strftime(origination_date, '%Y-%m-%d %H:%M:%S') as origination_date, loan_term_months, interest_rate, loan_type,
  loan_status, current_balance, monthly_payment from loans"""


@register("a1_csv_round_trip", with_ctes(_LOANS_AS_TEXT, "loans"))
def _(spark, d):
    path = files.write_csv(catalog.conform(adapters.loans(spark, d), schemas.LOANS), scratch_path(spark, "loans"))
    return files.read_csv(spark, path, schemas.LOANS)


@register("a2_json_round_trip", with_ctes("select * from education", "education"))
def _(spark, d):
    path = files.write_json(adapters.education(spark, d), scratch_path(spark, "education"))
    return files.read_json(spark, path, schemas.EDUCATION, array=False)


@register(
    "a1_rejects",
    with_ctes(
        """select loan_id as record, 'loan_amount' as "column", 'n/a' as value, 'not a double' as reason from loans where loan_id like '%3'
        union all select loan_id, 'interest_rate', 'high', 'not a double' from loans where loan_id like '%7'
        union all select loan_id, 'loan_term_months', 'many', 'not a int' from loans where loan_id like '%7'
        union all select 'typed rows', null, count(*)::varchar, null from loans""",
        "loans",
    ),
)
def _(spark, d):
    """Planted faults in a CSV file, found again; the last row counts the typed rows."""
    loans = catalog.conform(adapters.loans(spark, d), schemas.LOANS)
    text = loans.select(*[F.col(c).cast("string").alias(c) for c in loans.columns])
    ends = lambda digit, fault, name: F.when(F.col("loan_id").endswith(digit), F.lit(fault)).otherwise(F.col(name))
    bad = text.withColumns(
        {"loan_amount": ends("3", "n/a", "loan_amount"), "interest_rate": ends("7", "high", "interest_rate"), "loan_term_months": ends("7", "many", "loan_term_months")}
    )
    rows, rejects = files.read_checked(spark, files.write_csv(bad, f"{scratch_path(spark, 'loans')}.csv"), schemas.LOANS, "loan_id")
    none = F.lit(None).cast("string")
    count = rows.agg(F.lit("typed rows").alias("record"), none.alias("column"), F.count(F.lit(1)).cast("string").alias("value"), none.alias("reason"))
    return rejects.unionByName(count)


@register(
    "a2_rejects",
    with_ctes(
        """select borrower_id as record, 'gpa' as "column", 'four' as value, 'not a double' as reason from education
          where borrower_id like '%3'
        union all select null, null, '{broken ' || borrower_id, 'unreadable record' from education where borrower_id like '%9'
        union all select 'typed rows', null, count(*)::varchar, null from education where borrower_id not like '%9'""",
        "education",
    ),
)
def _(spark, d):
    """Planted faults in JSON lines, found again; the last row counts the typed rows."""
    education = adapters.education(spark, d)
    gpa = F.when(F.col("borrower_id").endswith("3"), F.lit("four")).otherwise(F.col("gpa").cast("string"))
    whole = F.to_json(F.struct(*[gpa.alias(c) if c == "gpa" else F.col(c) for c in education.columns]))
    line = F.when(F.col("borrower_id").endswith("9"), F.concat(F.lit("{broken "), "borrower_id")).otherwise(whole)
    path = f"{scratch_path(spark, 'education')}.json"
    education.select(line.alias("value")).write.text(path)
    rows, rejects = files.read_checked(spark, path, schemas.EDUCATION, "borrower_id")
    none = F.lit(None).cast("string")
    count = rows.agg(F.lit("typed rows").alias("record"), none.alias("column"), F.count(F.lit(1)).cast("string").alias("value"), none.alias("reason"))
    return rejects.unionByName(count)


@register(
    "i4_rejects",
    with_ctes(
        """select borrower_id as record, 'malformed' as kind, 'age' as field, 'old' as value from requests where borrower_id like '%3'
        union all select borrower_id, 'malformed', 'loan_count', '1.5x' from requests where borrower_id like '%35'
        union all select borrower_id, 'missing', 'annual_income', null from requests where annual_income is null
        union all select borrower_id, 'outside', 'credit_score_at_origination', '990' from requests where borrower_id like '%8'""".replace(
            "from requests", "from (select * from borrowers join loan_summary using (borrower_id))"
        ),
        "borrowers",
        "loan_summary",
    ),
)
def _(spark, d):
    """Every fault of a file of core requests with planted ones: malformed, missing, out of range."""
    requests = core_requests_of(spark, d)
    id_ = F.col("borrower_id")
    planted = {"age": ("3", "old"), "loan_count": ("35", "1.5x"), "credit_score_at_origination": ("8", "990")}
    # Values in range otherwise, so that only the planted ones are outside.
    bad = requests.select(
        "borrower_id",
        *[
            F.when(id_.endswith(planted[c][0]), F.lit(planted[c][1])).otherwise(F.col(c).cast("string")).alias(c) if c in planted else F.col(c).cast("string").alias(c)
            for c in schemas.CORE_FIELDS
        ],
    )
    fields = StructType([schemas.REQUEST[c] for c in ["borrower_id", *schemas.CORE_FIELDS]])
    path = files.write_csv(bad, f"{scratch_path(spark, 'requests')}.csv")
    return request_faults(*files.read_checked(spark, path, fields, "borrower_id"))


@register(
    "a4_conform",
    with_ctes(
        """select payment_id, loan_id, borrower_id, strftime(payment_date, '%Y-%m-%d %H:%M:%S') as payment_date,
          case when days_late <> 7 then scheduled_amount end as scheduled_amount, actual_amount, payment_status, days_late
        from payments""",
        "payments",
    ),
)
def _(spark, d):
    messy = adapters.payments(spark, d).select(
        "days_late",
        F.lit("x").alias("not_in_contract"),
        "actual_amount",
        F.when(F.col("days_late") == 7, F.lit(float("nan"))).otherwise(F.col("scheduled_amount")).alias("scheduled_amount"),
        "payment_status",
        "payment_date",
        "payment_id",
        "borrower_id",
        "loan_id",
    )
    return catalog.conform(messy, schemas.PAYMENTS)


@register("a6_row_cap", with_ctes("select * from borrowers order by borrower_id limit 100", "borrowers"))
def _(spark, d):
    return catalog.row_cap(adapters.borrowers(spark, d), "borrower_id", 100)


_TABLE_COUNTS = """select table_name, row_count from (
  select 'student_loan_borrowers' as table_name, count(*) as row_count from borrowers
  union all select 'student_loan_education', count(*) from education
  union all select 'student_loan_loans', count(*) from loans
  union all select 'student_loan_payments', count(*) from payments
  union all select 'student_loan_delinquency_features', count(*) from features
  union all select 'student_loan_master_dataset', count(*) from master
  union all select 'realistic_student_loan_dataset', count(*) from master)"""
_WITH_TOTAL = f"""select * from ({_TABLE_COUNTS}) union all
  select 'TOTAL', cast(sum(row_count) as bigint) from ({_TABLE_COUNTS})"""


def _frames(spark: SparkSession, d: str, written: bool = False) -> dict[str, DataFrame]:
    """The tables of the warehouse; ``written``: those that others are derived from are computed once and read back."""
    once = materialise if written else lambda df, name: df
    pay, loan = once(adapters.payments(spark, d), "payments"), adapters.loans(spark, d)
    own, school = adapters.borrowers(spark, d), adapters.education(spark, d)
    features = once(pay_ops.delinquency_features(pay), "features")
    master = once(master_ops.with_factor_targets(master_ops.join_master(own, school, features, loan)), "master")
    return {
        "student_loan_borrowers": own,
        "student_loan_education": school,
        "student_loan_loans": loan,
        "student_loan_payments": pay,
        "student_loan_delinquency_features": features,
        "student_loan_master_dataset": master,
        "realistic_student_loan_dataset": master,
    }


@register("a7_warehouse_load", with_ctes(_WITH_TOTAL, "borrowers", "education", "loans", "payments", "master"))
def _(spark, d):
    return catalog.load_all(spark, "delinq_warehouse", _frames(spark, d, written=True), location=scratch_path(spark, "warehouse"))


@register("a8_table_summary", with_ctes(_WITH_TOTAL, "borrowers", "education", "loans", "payments", "master"))
def _(spark, d):
    return portfolio.table_counts(**_frames(spark, d))


@register("a10_json_sink", with_ctes("select * from outreach", "outreach"))
def _(spark, d):
    listed = outreach_of(spark, d)
    path = files.write_json(listed, scratch_path(spark, "outreach"))
    return files.read_json(spark, path, listed.schema, array=False)
