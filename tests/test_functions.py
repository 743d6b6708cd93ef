from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from delinq.functions import borrower as B
from delinq.functions import loan as L
from delinq.functions import response as R
from delinq.functions import risk as K
from delinq.functions.action import ACTION_PRIORITY, priority_level, recommended_action, total_owed
from delinq.functions.numeric import clip, flag, nan_to_null, np_round, ratio, uniform


def column(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def evaluate(spark, values, expression, kind="double"):
    rows = column(spark, values, kind).select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
    return [r["y"] for r in rows]


def test_np_round_equals_numpy(spark):
    rng = np.random.default_rng(0)
    values = list(rng.uniform(-500, 500, 3000)) + [0.125, 2.675, 1.005, 0.5, 1.5, -2.5]
    for digits in (0, 1, 2, 3):
        got = evaluate(spark, [float(v) for v in values], lambda x: np_round(x, digits))
        assert got == list(np.round(np.array(values), digits))


def test_bands_are_open_left_closed_right(spark):
    ages = [0, 1, 25, 26, 35, 45, 46, 100, 101, None]
    want = [None, "Young", "Young", "Middle", "Middle", "Mature", "Senior", "Senior", None, None]
    assert evaluate(spark, ages, B.age_group, "int") == want
    incomes = [0.0, 30000.0, 30000.01, 50000.0, 75000.0, 100000.0, 100000.01, 1e9, None]
    want = [None, "Low", "Lower-Middle", "Lower-Middle", "Middle", "Upper-Middle", "High", "High", None]
    assert evaluate(spark, incomes, B.income_category) == want
    scores = [0, 580, 581, 670, 740, 800, 850, 851]
    want = [None, "Poor", "Fair", "Fair", "Good", "Very Good", "Excellent", None]
    assert evaluate(spark, scores, B.credit_category, "int") == want


def test_bands_equal_pandas_cut(spark):
    values = [float(v) for v in np.random.default_rng(1).uniform(-10, 120, 500)]
    want = pd.cut(values, bins=[0, 25, 35, 45, 100], labels=["Young", "Middle", "Mature", "Senior"])
    got = evaluate(spark, values, B.age_group)
    assert got == [None if pd.isna(w) else w for w in want]


def test_three_scales(spark):
    p = [0.0, 0.3, 0.31, 0.6, 0.7, 0.71, 0.8, 0.81, 1.0, None]
    assert evaluate(spark, p, K.model_category) == [
        None, "Low", "Medium", "Medium", "High", "High", "High", "Critical", "Critical", None,
    ]
    assert evaluate(spark, p, K.service_category) == [
        "Low", "Low", "Medium", "Medium", "Medium", "High", "High", "High", "High", None,
    ]
    s = [0.0, 25.0, 25.01, 50.0, 75.0, 75.01, 100.0, 100.01]
    want = [None, "Low", "Medium", "Medium", "High", "Critical", "Critical", None]
    assert evaluate(spark, s, K.score_category) == want


def test_flags_treat_null_and_nan_as_no(spark):
    df = spark.createDataFrame(
        [(None, None, None, None), (float("nan"), float("nan"), float("nan"), float("nan")), (0.41, 3.6, 0.11, 1.0)],
        "debt_to_income_ratio double, gpa double, missed_payment_rate double, recent_missed_payments double",
    )
    for name, kind in (
        ("loan_count", "int"), ("total_loan_amount", "double"), ("degree_type", "string"),
        ("completion_status", "string"), ("state", "string"), ("employment_status", "string"),
    ):
        df = df.withColumn(name, F.lit(None).cast(kind))
    rows = nan_to_null(df).select(*[c.alias(n) for n, c in B.flag_columns().items()]).collect()
    assert all(v == 0 for v in rows[0]) and all(v == 0 for v in rows[1])
    on = {n for n, v in rows[2].asDict().items() if v}
    assert on == {"high_debt_burden", "high_gpa", "frequent_late_payments", "recent_payment_issues"}


def test_clip_keeps_null(spark):
    assert evaluate(spark, [None, -1.0, 3.0, 9.0], lambda x: clip(x, 0.0, 5.0)) == [None, 0.0, 3.0, 5.0]


def test_ratio_of_zero_and_null(spark):
    assert evaluate(spark, [0.0, None, 2.0], lambda x: ratio(F.lit(1.0), x)) == [0.0, 0.0, 0.5]


def test_clock_is_a_parameter(spark):
    as_of = dt.date(2025, 6, 1)
    assert evaluate(spark, [2023, 2022, None], lambda y: B.recent_graduate(y, as_of), "int") == [1, 0, 0]
    assert evaluate(spark, [2023, 2022], lambda y: B.years_since_graduation(y, as_of), "int") == [2, 3]


def test_monthly_payment(spark):
    got = evaluate(spark, [10000.0, 25000.0], lambda p: L.monthly_payment(p, F.lit(6.0), F.lit(120)))
    want = [round(p * 0.005 / (1 - 1.005**-120), 2) for p in (10000, 25000)]
    assert got == want
    assert evaluate(spark, [10000.0], lambda p: L.monthly_payment(p, F.lit(0.0), F.lit(120))) == [None]


def test_payment_status_limits(spark):
    days = [0, 1, 30, 31, 60, 61, 119]
    want = ["On Time", "1-30 Days Late", "1-30 Days Late", "31-60 Days Late", "31-60 Days Late"] + ["Missed Payment"] * 2
    assert evaluate(spark, days, L.payment_status, "int") == want
    assert evaluate(spark, [60, 61], lambda x: L.paid_amount(x, F.lit(5.0)), "int") == [5.0, 0.0]


def test_debt_to_income_of_zero_income(spark):
    assert evaluate(spark, [0.0, 60000.0, None], lambda x: L.debt_to_income(F.lit(500.0), x)) == [None, 0.1, None]


def test_ids(spark):
    assert evaluate(spark, [7], lambda x: L.format_id("borrower", x), "int") == ["BOR_000007"]
    assert evaluate(spark, [1234567890], lambda x: L.format_id("loan", x), "bigint") == ["LOAN_1234567890"]


def python_factor_score(credit, dti, rate, missed, work):
    points = 35 if credit < 580 else 20 if credit < 650 else 10 if credit < 720 else 2
    points += 25 if dti > 0.25 else 15 if dti > 0.15 else 8 if dti > 0.10 else 2
    points += min(20, rate * 50)
    points += min(10, missed * 3)
    points += {"Unemployed": 15, "Student": 8, "Part-time": 5, "Employed Part-time": 5}.get(work, 0)
    return min(100, max(0, points))


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.integers(300, 850),
            st.floats(0, 3),
            st.floats(0, 1),
            st.integers(0, 9),
            st.sampled_from(["Unemployed", "Student", "Part-time", "Employed Part-time", "Employed"]),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_factor_score_property(spark, rows):
    df = spark.createDataFrame(
        [(i, c, d, r, float(m), w) for i, (c, d, r, m, w) in enumerate(rows)],
        "i int, c int, d double, r double, m double, w string",
    )
    got = df.select("i", K.factor_score(F.col("c"), F.col("d"), F.col("r"), F.col("m"), F.col("w")).alias("s"))
    for row in got.collect():
        assert row["s"] == python_factor_score(*rows[row["i"]])
        assert 0 <= row["s"] <= 100


def test_factor_score_defaults(spark):
    assert evaluate(spark, [600], lambda c: K.factor_score(c), "int") == [20 + 8]


def test_behaviour_rules(spark):
    assert evaluate(spark, [1.0], lambda x: K.behaviour_score(x, F.lit(45.0), F.lit(61))) == [100.0]
    assert evaluate(spark, [0.1], lambda x: K.behaviour_score(x, F.lit(3.0), F.lit(60))) == [7.0]
    assert evaluate(spark, [1, 2], lambda x: K.behaviour_target(x, F.lit(30.0), F.lit(90)), "int") == [0, 1]
    assert evaluate(spark, [90, 91], lambda x: K.behaviour_target(F.lit(0), F.lit(30.0), x), "int") == [0, 1]


def test_category_grows_with_probability(spark):
    p = sorted(float(x) for x in np.random.default_rng(2).uniform(0.001, 1, 300))
    order = {"Low": 0, "Medium": 1, "High": 2, "Critical": 3}
    ranks = [order[c] for c in evaluate(spark, p, K.model_category)]
    assert ranks == sorted(ranks)


def test_draw_is_repeatable_and_follows_probability(spark):
    ids = spark.range(20000).select(F.concat(F.lit("B"), F.col("id")).alias("k"))
    draw = lambda parts: ids.repartition(parts).select(
        "k", K.delinquency_draw(F.col("k"), F.lit(50.0), 7).alias("d")
    )
    a = {r["k"]: r["d"] for r in draw(1).collect()}
    b = {r["k"]: r["d"] for r in draw(13).collect()}
    assert a == b
    assert abs(sum(a.values()) / len(a) - 0.5) < 0.02
    u = ids.select(uniform(F.col("k"), 1).alias("u")).agg(F.min("u"), F.max("u")).first()
    assert 0 <= u[0] < 0.01 and 0.99 < u[1] < 1


def test_fallback_and_interval(spark):
    assert evaluate(spark, [850, 300, None], lambda c: K.fallback_probability(c, F.lit(0.0)), "int") == pytest.approx(
        [0.1, 0.9, 200 / 550]
    )
    rows = column(spark, [0.0, 0.5, 1.0, None]).select("i", K.confidence_interval(F.col("x")).alias("c")).orderBy("i").collect()
    assert [(r["c"]["lower_bound"], r["c"]["upper_bound"]) for r in rows[:3]] == [(0.0, 0.005), (0.495, 0.505), (0.995, 1.0)]
    assert rows[3]["c"] is None


def test_quick_score_of_demo_profiles(spark):
    rows = [(800, 85000.0, 25000.0), (720, 55000.0, 45000.0), (580, 35000.0, 65000.0)]
    rows += [(700, None, 40000.0), (None, 55000.0, 45000.0), (720, 55000.0, None)]
    df = spark.createDataFrame(rows, "c int, i double, l double")
    got = [r[0] for r in df.select(K.quick_score(F.col("c"), F.col("i"), F.col("l"))).collect()]
    assert got == [0.0, 11.0, 32.0, None, None, None]


def test_action_cascade(spark):
    df = spark.createDataFrame(
        [(91, "Low"), (90, "Low"), (31, "Critical"), (30, "Critical"), (0, "High"), (0, "Medium"), (0, "Low"), (0, None)],
        "d int, c string",
    )
    action = recommended_action(F.col("d"), F.col("c"))
    rows = df.select(action.alias("a"), priority_level(action).alias("p")).collect()
    assert [r["a"] for r in rows] == [
        "Immediate Collection Action",
        "Urgent Payment Arrangement",
        "Urgent Payment Arrangement",
        "Proactive Outreach - High Priority",
        "Proactive Outreach - Medium Priority",
        "Educational Communication",
        "Standard Monitoring",
        "Standard Monitoring",
    ]
    assert all(ACTION_PRIORITY[r["a"]] == r["p"] for r in rows)
    owed = spark.range(1).select(total_owed(F.lit(100.0), F.lit(1)), total_owed(F.lit(100.0), F.lit(0))).first()
    assert owed[0] == pytest.approx(110.0) and owed[1] == 100.0


def test_prediction_map_and_consensus(spark):
    df = spark.createDataFrame([(0.75, 0.5, None), (0.1, 0.31, 0.7)], "a double, b double, c double")
    m = R.prediction_map({"a": F.col("a"), "b": F.col("b"), "c": F.col("c")})
    rows = df.select(m.alias("m"), R.consensus_text(m).alias("t")).collect()
    assert set(rows[0]["m"]) == {"a", "b"} and rows[0]["m"]["a"]["risk_score"] == 75.0
    assert rows[0]["t"] == "Consensus: 1 High, 1 Medium, 0 Low risk predictions"
    assert rows[1]["t"] == "Consensus: 0 High, 2 Medium, 1 Low risk predictions"


def test_unwrap_empty_and_broken_bodies(spark):
    bodies = ['{}', 'not json', '{"response":{"prediction":{"all_model_predictions":{}}}}']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    for row in df.select(R.unwrap_response(F.col("body")).alias("r")).select("r.*").collect():
        assert row["risk_probability"] == 0.0 and row["risk_score"] == 0.0 and row["risk_category"] == "Low"


def test_flag_of_unknown(spark):
    assert evaluate(spark, [None, 1.0, -1.0], lambda x: flag(x > 0)) == [0, 1, 0]


def test_sigmoid(spark):
    got = evaluate(spark, [50.0, 60.0], K.delinquency_probability)
    assert got == pytest.approx([0.5, 1 / (1 + math.exp(-1))])
