"""Scores, probabilities and category scales."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from delinq.functions.borrower import band
from delinq.functions.numeric import clip, flag, np_round, uniform

# Right-closed scale edges.
MODEL_SCALE = [(0.3, "Low"), (0.6, "Medium"), (0.8, "High"), (1.0, "Critical")]
SCORE_SCALE = [(25, "Low"), (50, "Medium"), (75, "High"), (100, "Critical")]


def behaviour_score(missed_rate: Column, recent_avg_days: Column, max_days: Column) -> Column:
    """0-100 score of payment behaviour, one decimal."""
    raw = missed_rate * 40 + recent_avg_days / 30 * 30 + flag(max_days > 60) * 30
    return np_round(clip(raw, 0.0, 100.0), 1)


def behaviour_target(recent_missed: Column, recent_avg_days: Column, max_days: Column) -> Column:
    return flag((recent_missed >= 2) | (recent_avg_days > 30) | (max_days > 90))


def factor_score(
    credit: Column,
    dti: Column | None = None,
    missed_rate: Column | None = None,
    recent_missed: Column | None = None,
    employment: Column | None = None,
) -> Column:
    """0-100 score from credit, debt burden, payment behaviour and employment.

    An argument left out stands for a field the input does not have and gets its default.
    """
    dti = F.lit(0.15) if dti is None else dti
    missed_rate = F.lit(0.0) if missed_rate is None else missed_rate
    recent_missed = F.lit(0.0) if recent_missed is None else recent_missed
    employment = F.lit("Employed") if employment is None else employment
    # Points per factor.
    credit_points = F.when(credit < 580, 35).when(credit < 650, 20).when(credit < 720, 10).otherwise(2)
    dti_points = F.when(dti > 0.25, 25).when(dti > 0.15, 15).when(dti > 0.10, 8).otherwise(2)
    lifetime, recent = F.least(F.lit(20.0), missed_rate * 50), F.least(F.lit(10.0), recent_missed * 3)
    work = (
        F.when(employment == "Unemployed", 15)
        .when(employment == "Student", 8)
        .when(employment.isin("Part-time", "Employed Part-time"), 5)
        .otherwise(0)
    )
    # Added one by one in this order: sums of doubles depend on it in the last digit.
    return clip(credit_points + dti_points + lifetime + recent + work, 0.0, 100.0)


def delinquency_probability(score: Column) -> Column:
    """Sigmoid around a score of 50 with width 10."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(score - 50) / 10))


def delinquency_draw(key: Column, score: Column, seed: int) -> Column:
    """Repeatable 0/1 draw with the sigmoid probability of the score."""
    return flag(uniform(key, seed) < delinquency_probability(score))


def model_category(probability: Column) -> Column:
    """Four-step scale of model probabilities; exactly 0 has no category."""
    return band(probability, MODEL_SCALE)


def service_category(probability: Column) -> Column:
    """Three-step scale of the serving interface, on the unrounded probability."""
    return (
        F.when(probability > 0.7, "High").when(probability > 0.3, "Medium").when(probability.isNotNull(), "Low")
    )


def score_category(score: Column) -> Column:
    """Four-step scale of 0-100 scores."""
    return band(score, SCORE_SCALE)


def quick_score(credit: Column, income: Column, loan_amount: Column) -> Column:
    """Score of a bare request that carries only the core fields; unknown if one of them is."""
    raw = (
        (F.lit(800.0) - credit) / 10
        + F.when(income.isNotNull(), F.greatest(F.lit(0.0), (F.lit(50000.0) - income) / 5000))
        + (loan_amount - 30000) / 5000
    )
    return clip(raw, 0.0, 100.0)


def fallback_probability(credit: Column, dti: Column) -> Column:
    """Rule-based probability for when no model is at hand."""
    credit = F.coalesce(credit, F.lit(650))
    dti = F.coalesce(dti, F.lit(0.5))
    return clip((F.lit(850.0) - credit) / 550 + dti * 0.3, 0.1, 0.9)


def confidence_interval(probability: Column, confidence: float = 0.95) -> Column:
    margin = 0.1 * (1 - confidence)
    low = F.greatest(F.lit(0.0), probability - margin)
    high = F.least(F.lit(1.0), probability + margin)
    return F.when(
        probability.isNotNull(),
        F.struct(np_round(low, 4).alias("lower_bound"), np_round(high, 4).alias("upper_bound")),
    )
