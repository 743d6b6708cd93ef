"""Bands, flags and clipping of borrower attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from delinq.functions.numeric import clip, flag

# Right-closed bands as (upper edge, label); the lower edge of the first is 0.
AGE_BANDS = [(25, "Young"), (35, "Middle"), (45, "Mature"), (100, "Senior")]
INCOME_BANDS = [
    (30000, "Low"),
    (50000, "Lower-Middle"),
    (75000, "Middle"),
    (100000, "Upper-Middle"),
    (float("inf"), "High"),
]
CREDIT_BANDS = [(580, "Poor"), (670, "Fair"), (740, "Good"), (800, "Very Good"), (850, "Excellent")]

# Thresholds and members of the 0/1 flags.
HIGH_RISK_STATES = ["NV", "FL", "AZ", "CA", "MI"]
GRADUATE_DEGREES = ["Masters", "Doctorate"]


def band(x: Column, bands: list[tuple[float, str]], first_edge: float = 0) -> Column:
    """Label of the band (left open, right closed) that holds x; NULL outside all bands."""
    out = F.when(x <= F.lit(first_edge), F.lit(None).cast("string"))
    for upper, label in bands:
        out = out.when(x <= F.lit(upper), F.lit(label))
    return out


def age_group(age: Column) -> Column:
    return band(age, AGE_BANDS)


def income_category(income: Column) -> Column:
    return band(income, INCOME_BANDS)


def credit_category(score: Column) -> Column:
    return band(score, CREDIT_BANDS)


def flag_columns() -> dict[str, Column]:
    """The ten clock-free 0/1 flags, keyed by output name."""
    c = F.col
    return {
        "high_debt_burden": flag(c("debt_to_income_ratio") > 0.4),
        "multiple_loans": flag(c("loan_count") > 1),
        "large_loan_amount": flag(c("total_loan_amount") > 50000),
        "frequent_late_payments": flag(c("missed_payment_rate") > 0.1),
        "recent_payment_issues": flag(c("recent_missed_payments") > 0),
        "high_gpa": flag(c("gpa") > 3.5),
        "graduate_degree": flag(c("degree_type").isin(GRADUATE_DEGREES)),
        "completed_education": flag(c("completion_status") == "Completed"),
        "high_risk_state": flag(c("state").isin(HIGH_RISK_STATES)),
        "stable_employment": flag(c("employment_status") == "Employed Full-time"),
    }


def years_since_graduation(year: Column, as_of: dt.date) -> Column:
    return F.lit(as_of.year) - year


def recent_graduate(year: Column, as_of: dt.date) -> Column:
    return flag(years_since_graduation(year, as_of) <= 2)


def engineered_columns(as_of: dt.date) -> dict[str, Column]:
    """All engineered features: three bands, ten flags, years since graduation, recent flag."""
    c = F.col
    return {
        "age_group": age_group(c("age")),
        "income_category": income_category(c("annual_income")),
        "credit_category": credit_category(c("credit_score_at_origination")),
        **flag_columns(),
        "years_since_graduation": years_since_graduation(c("graduation_year"), as_of),
        "recent_graduate": recent_graduate(c("graduation_year"), as_of),
    }


# Bounds of the extreme-value clipping.
CLIP_BOUNDS = {
    "annual_income": (0.0, 500000.0),
    "debt_to_income_ratio": (0.0, 5.0),
    "risk_score": (0.0, 100.0),
}


def clipped_columns() -> dict[str, Column]:
    return {name: clip(F.col(name), low, high) for name, (low, high) in CLIP_BOUNDS.items()}
