"""Loan and payment arithmetic, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from delinq.functions.numeric import np_round


def monthly_payment(principal: Column, rate_percent: Column, months: Column) -> Column:
    """Level payment of an amortised loan, rounded to cents; NULL for a zero rate or term."""
    r = rate_percent / F.lit(1200.0)
    return np_round(F.try_divide(principal * r, F.lit(1.0) - F.pow(F.lit(1.0) + r, -months)), 2)


def payment_status(days_late: Column) -> Column:
    # Status names and day limits.
    return (
        F.when(days_late <= 0, "On Time")
        .when(days_late <= 30, "1-30 Days Late")
        .when(days_late <= 60, "31-60 Days Late")
        .when(days_late > 60, "Missed Payment")
    )


def paid_amount(days_late: Column, scheduled: Column) -> Column:
    """A missed payment pays nothing; a late one pays in full."""
    return F.when(days_late > 60, F.lit(0.0)).otherwise(scheduled)


def debt_to_income(monthly: Column, income: Column) -> Column:
    return np_round(F.try_divide(monthly * F.lit(12.0), income), 3)


# Identifier formats.
ID_FORMATS = {"borrower": "BOR_%06d", "loan": "LOAN_%08d", "payment": "PAY_%08d", "account": "ML_%08d"}


def format_id(kind: str, key: Column) -> Column:
    """Identifier text from a numeric key (never from a running row number)."""
    return F.format_string(ID_FORMATS[kind], key)
