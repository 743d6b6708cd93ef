"""Request completion, validation and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delinq import schemas
from delinq.functions.risk import quick_score


class MissingFieldsError(ValueError):
    """The input lacks required columns."""


def require_core_fields(df: DataFrame, with_id: bool = False) -> DataFrame:
    """Check the schema before any job runs; names the missing columns."""
    required = (["borrower_id"] if with_id else []) + schemas.CORE_FIELDS
    missing = [f for f in required if f not in df.columns]
    if missing:
        raise MissingFieldsError(f"Core required fields missing: {missing}")
    return df


def core_field_nulls(df: DataFrame) -> DataFrame:
    """Nulls per core field and rows that have any, in one pass."""
    require_core_fields(df)
    return df.agg(
        F.count(F.lit(1)).alias("requests"),
        *[F.count_if(F.col(f).isNull()).alias(f"{f}_nulls") for f in schemas.CORE_FIELDS],
        F.count_if(_null_core_fields_count() > 0).alias("rejected"),
    )


def _null_core_fields() -> Column:
    marks = [F.when(F.col(f).isNull(), F.lit(f)) for f in schemas.CORE_FIELDS]
    return F.array_compact(F.array(*marks))


def _null_core_fields_count() -> Column:
    return F.size(_null_core_fields())


def with_request_errors(df: DataFrame) -> DataFrame:
    """Add ``error`` and ``error_type``; both NULL for a good request.

    Bad rows become error records, they do not fail the job.
    """
    require_core_fields(df)
    names = _null_core_fields()
    bad = F.size(names) > 0
    # Message format and error type.
    quoted = F.array_join(F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'"))), ", ")
    text = F.concat(F.lit("Null values found in core required fields: ["), quoted, F.lit("]"))
    return df.withColumns({"error": F.when(bad, text), "error_type": F.when(bad, F.lit("ValueError"))})


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into good rows and rejected rows with their reason."""
    checked = with_request_errors(df)
    good = checked.filter(F.col("error").isNull()).drop("error", "error_type")
    return good, checked.filter(F.col("error").isNotNull())


# Defaults of fields a request may leave out.
CONSTANT_DEFAULTS: dict[str, object] = {
    "dependents": 1,
    "gpa": 3.0,
    "graduation_year": 2020,
    "avg_interest_rate": 6.0,
    "avg_days_late": 5.0,
    "max_days_late": 30,
    "std_days_late": 10.0,
    "total_payment_count": 12,
    "missed_payment_count": 1,
    "payment_ratio": 0.95,
    "missed_payment_rate": 0.05,
    "recent_avg_days_late": 5.0,
    "recent_missed_payments": 1,
    "gender": "Other",
    "state": "CA",
    "employment_status": "Employed",
    "housing_status": "Rent",
    "school_name": "State University",
    "degree_type": "Bachelors",
    "major": "Business",
    "school_type": "Public",
    "completion_status": "Completed",
}


def fill_request_defaults(df: DataFrame) -> DataFrame:
    """Add every absent request field and order the columns: others first, then features.

    A field that is present keeps its values, nulls included.
    """
    require_core_fields(df)
    c = F.col
    derived: dict[str, Column] = {
        "debt_to_income_ratio": F.try_divide(c("total_monthly_payment") * 12, c("annual_income")),
        "avg_loan_amount": F.try_divide(c("total_loan_amount"), c("loan_count")),
        "total_current_balance": c("total_loan_amount") * 0.9,
        "total_payments_made": c("total_monthly_payment") * 12,
        "risk_score": quick_score(
            c("credit_score_at_origination"), c("annual_income"), c("total_loan_amount")
        ),
    }
    features = schemas.NUMERIC_FEATURES + schemas.CATEGORICAL_FEATURES
    absent = [f for f in features if f not in df.columns]
    out = df.withColumns(
        {f: derived[f] if f in derived else F.lit(CONSTANT_DEFAULTS[f]) for f in absent if f != "total_scheduled"}
    )
    if "total_scheduled" in absent:  # builds on total_payments_made, given or derived
        out = out.withColumn("total_scheduled", c("total_payments_made") * 1.05)
    others = [name for name in out.columns if name not in features]
    return out.select(*others, *features)


def contract_rules(columns: list[str]) -> dict[str, Column]:
    """Violation test per rule for the columns at hand; NULL never violates a range or a list."""
    rules: dict[str, Column] = {}
    for name, (low, high) in schemas.FIELD_RANGES.items():
        if name not in columns:
            continue
        if low is not None:
            rules[f"{name}_minimum"] = F.col(name) < low
        if high is not None:
            rules[f"{name}_maximum"] = F.col(name) > high
    for name, allowed in schemas.FIELD_VALUES.items():
        if name in columns:
            rules[f"{name}_values"] = ~F.col(name).isin(allowed)
    return rules


def _rule_field(rule: str) -> str:
    return rule.rsplit("_", 1)[0]


def contract_violations(df: DataFrame, key: str = "borrower_id") -> DataFrame:
    """One row per violated rule: key, rule, field, offending value as text."""
    cells = [
        F.when(
            bad,
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(_rule_field(rule)).alias("field"),
                F.col(_rule_field(rule)).cast("string").alias("value"),
            ),
        )
        for rule, bad in contract_rules(df.columns).items()
    ]
    return df.select(key, F.inline(F.array_compact(F.array(*cells))))


def request_faults(typed: DataFrame, rejects: DataFrame, key: str = "borrower_id") -> DataFrame:
    """Everything wrong with the requests of a checked read, a row a fault: record, kind, field, value.

    Kinds: "malformed" values and records, "missing" core fields (a malformed one is not missing, too) and values that
    are "outside" their range or list.
    """
    require_core_fields(typed, with_id=True)
    malformed = rejects.select("record", F.lit("malformed").alias("kind"), F.col("column").alias("field"), "value")
    missing = typed.select(F.col(key).alias("record"), F.explode(_null_core_fields()).alias("field"))
    missing = missing.join(rejects.select("record", F.col("column").alias("field")).dropDuplicates(), ["record", "field"], "left_anti")
    outside = contract_violations(typed, key)
    return malformed.unionByName(
        missing.select("record", F.lit("missing").alias("kind"), "field", F.lit(None).cast("string").alias("value"))
    ).unionByName(outside.select(F.col(key).alias("record"), F.lit("outside").alias("kind"), "field", "value"))


def violation_counts(df: DataFrame) -> DataFrame:
    """Violations per rule, rules without any included; one pass, one row of sums unfolded."""
    rules = contract_rules(df.columns)
    sums = df.agg(*[F.count_if(bad).alias(rule) for rule, bad in rules.items()])
    cells = [F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("violations")) for rule in rules]
    return sums.select(F.inline(F.array(*cells)))


def parse_requests(bodies: DataFrame, column: str = "body") -> DataFrame:
    """Request rows from JSON text: one record, a list of records, or {"data": [records]}.

    Fields a record leaves out are NULL here. Unreadable text gives one row of NULLs, which
    validation rejects.
    """
    record = schemas.REQUEST.simpleString()
    body = F.trim(F.col(column))
    one = F.array(F.from_json(body, record))
    many = F.from_json(body, f"array<{record}>")
    wrapped = F.from_json(body, f"struct<data:array<{record}>>")["data"]
    records = F.when(body.startswith("["), many).otherwise(F.coalesce(wrapped, one))
    return bodies.select(F.inline_outer(records))
