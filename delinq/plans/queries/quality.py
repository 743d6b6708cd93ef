"""Registered queries: data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from delinq import schemas
from delinq.operators import requests
from delinq.plans.base import core_requests_of, master_of, register
from delinq.plans.check_sql import with_ctes


_NULLS = ", ".join(f"count(*) filter (where {f} is null) as {f}_nulls" for f in schemas.CORE_FIELDS)
_ANY_NULL = " or ".join(f"{f} is null" for f in schemas.CORE_FIELDS)


@register(
    "i1_i2_core",
    with_ctes(
        f"""select count(*) as requests, {_NULLS}, count(*) filter (where {_ANY_NULL}) as rejected
        from borrowers join loan_summary using (borrower_id)""",
        "borrowers",
        "loan_summary",
    ),
)
def _(spark, d):
    return requests.core_field_nulls(core_requests_of(spark, d))


def _rule_sql() -> dict[str, str]:
    tests: dict[str, str] = {}
    for name, (low, high) in schemas.FIELD_RANGES.items():
        if low is not None:
            tests[f"{name}_minimum"] = f"{name} < {low}"
        if high is not None:
            tests[f"{name}_maximum"] = f"{name} > {high}"
    for name, allowed in schemas.FIELD_VALUES.items():
        tests[f"{name}_values"] = f"{name} not in ({', '.join(repr(a) for a in allowed)})"
    return tests


@register(
    "i3_contract",
    with_ctes(
        " union all ".join(
            f"select '{rule}' as rule, count(*) as violations from master where {test}" for rule, test in _rule_sql().items()
        ),
        "master",
    ),
)
def _(spark, d):
    return requests.violation_counts(master_of(spark, d))


@register(
    "i3_violations",
    with_ctes(
        " union all ".join(
            f"""select borrower_id, '{rule}' as rule, '{rule.rsplit("_", 1)[0]}' as field,
              cast({rule.rsplit("_", 1)[0]} as varchar) as value from master where {test}"""
            for rule, test in _rule_sql().items()
        ),
        "master",
    ),
)
def _(spark, d):
    return requests.contract_violations(master_of(spark, d))


@register(
    "i4_quarantine",
    with_ctes(
        """select borrower_id, annual_income is null as rejected, case when annual_income is null
            then 'Null values found in core required fields: [''annual_income'']' end as error,
          case when annual_income is null then 'ValueError' end as error_type
        from borrowers join loan_summary using (borrower_id)""",
        "borrowers",
        "loan_summary",
    ),
)
def _(spark, d):
    good, rejected = requests.quarantine(core_requests_of(spark, d))
    none = F.lit(None).cast("string")
    kept = good.select("borrower_id", F.lit(False).alias("rejected"), none.alias("error"), none.alias("error_type"))
    return kept.unionByName(rejected.select("borrower_id", F.lit(True).alias("rejected"), "error", "error_type"))
