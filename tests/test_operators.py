from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from delinq import schemas
from delinq.operators import loans as loan_ops
from delinq.operators import master as master_ops
from delinq.operators import metrics, preprocess, ranking, requests, sampling
from delinq.operators import outreach as out_ops
from delinq.operators import payments as pay_ops

PAYMENT = "borrower_id string, payment_id string, payment_date timestamp_ntz, scheduled_amount double, actual_amount double, payment_status string, days_late int"


def payments(spark, rows):
    def status(days):
        return "On Time" if days == 0 else "Missed Payment" if days > 60 else "1-30 Days Late" if days <= 30 else "31-60 Days Late"

    full = [(b, f"P{i}", when, s, 0.0 if late > 60 else s, status(late), late) for i, (b, when, s, late) in enumerate(rows)]
    return spark.createDataFrame(full, PAYMENT)


def test_cutoff_is_inclusive_and_clips_month_end(spark):
    last = dt.datetime(2024, 8, 31, 10)
    edge = dt.datetime(2024, 2, 29, 10)
    df = payments(
        spark,
        [("A", last, 100.0, 0), ("B", edge, 100.0, 70), ("C", edge - dt.timedelta(seconds=1), 100.0, 70)],
    )
    rows = {r["borrower_id"]: r for r in pay_ops.delinquency_features(df).collect()}
    assert rows["B"]["recent_missed_payments"] == 1.0
    assert rows["C"]["recent_missed_payments"] == 0.0 and rows["C"]["recent_avg_days_late"] == 0.0
    assert {r["borrower_id"] for r in pay_ops.recent_stats(df).collect()} == {"A", "B"}


def test_single_payment_has_zero_deviation(spark):
    df = payments(spark, [("A", dt.datetime(2024, 1, 1), 100.0, 5)])
    row = pay_ops.delinquency_features(df).first()
    assert row["std_days_late"] == 0.0 and row["payment_ratio"] == 1.0


def test_zero_scheduled_gives_zero_ratio(spark):
    df = payments(spark, [("A", dt.datetime(2024, 1, 1), 0.0, 0)])
    assert pay_ops.payment_stats(df).first()["payment_ratio"] == 0.0
    paid = df.withColumn("actual_amount", F.lit(5.0))
    assert pay_ops.payment_stats(paid).first()["payment_ratio"] == 0.0


def test_features_equal_the_two_step_form(spark, domain):
    whole = pay_ops.delinquency_features(domain["payments"])
    steps = (
        pay_ops.payment_stats(domain["payments"])
        .join(pay_ops.recent_stats(domain["payments"]), "borrower_id", "left")
        .na.fill(0)
    )
    same = [c for c in steps.columns if c != "recent_missed_payments"]
    a = sorted(map(tuple, whole.select(*same).collect()))
    assert a == sorted(map(tuple, steps.select(*same).collect()))


def test_features_do_not_depend_on_partitions(spark, domain):
    df = domain["payments"]
    a = sorted(map(tuple, pay_ops.delinquency_features(df.repartition(1)).collect()))
    b = sorted(map(tuple, pay_ops.delinquency_features(df.repartition(23)).collect()))
    assert a == b


def test_features_equal_pandas(spark, domain):
    pdf = domain["payments"].toPandas()
    pdf["missed"] = (pdf["payment_status"] == "Missed Payment").astype(int)
    grouped = pdf.groupby("borrower_id")
    want = pd.DataFrame(
        {
            "avg_days_late": grouped["days_late"].mean().round(2),
            "std_days_late": grouped["days_late"].std().round(2).fillna(0),
            "max_days_late": grouped["days_late"].max(),
            "missed_payment_count": grouped["missed"].sum(),
        }
    )
    got = pay_ops.delinquency_features(domain["payments"]).toPandas().set_index("borrower_id").loc[want.index]
    for name in want.columns:
        assert np.allclose(got[name].astype(float), want[name].astype(float), atol=1e-9), name


def test_trend_reads_few_rows_of_a_hot_borrower(spark):
    start = dt.datetime(2020, 1, 1)
    rows = [("HOT", start + dt.timedelta(days=i), 10.0, i % 50) for i in range(900)]
    rows += [(f"B{i}", start, 10.0, 4) for i in range(50)]
    df = payments(spark, rows)
    out = {r["borrower_id"]: r for r in pay_ops.last_payments_trend(df).collect()}
    assert out["HOT"]["payments_used"] == 6
    assert out["HOT"]["recent_trend"] == np.mean([i % 50 for i in range(894, 900)])
    plan = pay_ops.last_payments_trend(df)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_schedule_clips_month_ends(spark):
    loans = spark.createDataFrame(
        [("L", "B", dt.datetime(2024, 1, 31), 50.0)],
        "loan_id string, borrower_id string, origination_date timestamp_ntz, monthly_payment double",
    )
    rows = loan_ops.payment_schedule(loans, 4).orderBy("month_offset").collect()
    assert [r["due_date"].date().isoformat() for r in rows] == ["2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30"]


def test_master_drops_incomplete_borrowers(spark, domain):
    one = domain["master"].select("borrower_id").first()[0]
    fewer = domain["education"].filter(F.col("borrower_id") != one)
    master = master_ops.build_master(domain["borrowers"], fewer, domain["loans"], domain["payments"])
    assert master.filter(F.col("borrower_id") == one).isEmpty()
    assert master.columns == schemas.MASTER.names


def test_lookup_marks_unknown_ids(spark, domain):
    known = domain["master"].select("borrower_id").first()[0]
    ids = spark.createDataFrame([(known,), ("BOR_NONE",)], "borrower_id string")
    rows = {r["borrower_id"]: r for r in master_ops.lookup(domain["master"], ids).collect()}
    assert rows[known]["found"] and rows[known]["error"] is None
    assert not rows["BOR_NONE"]["found"] and rows["BOR_NONE"]["error"] == "Borrower BOR_NONE not found"
    assert master_ops.lookup_one(domain["master"], known).count() == 1


# --- order statistics -----------------------------------------------------------------------


def brute_auc(scores, labels):
    s, y = np.array(scores), np.array(labels)
    diff = s[y == 1][:, None] - s[y == 0][None, :]
    return ((diff > 0).sum() + 0.5 * (diff == 0).sum()) / diff.size


def brute_average_precision(scores, labels):
    s, y = np.array(scores), np.array(labels)
    total, last = 0.0, 0.0
    for threshold in sorted(set(scores), reverse=True):
        called = s >= threshold
        recall = (called & (y == 1)).sum() / (y == 1).sum()
        total += (recall - last) * (called & (y == 1)).sum() / called.sum()
        last = recall
    return total


@pytest.mark.parametrize("distinct", [3, 50, 100000])
def test_ranking_metrics_equal_brute_force(spark, distinct):
    rng = np.random.default_rng(distinct)
    scores = [float(v) for v in rng.integers(0, distinct, 1500)]
    labels = [int(v) for v in rng.integers(0, 2, 1500)]
    df = spark.createDataFrame(list(zip(scores, labels)), "s double, y int")
    row = metrics.ranking_metrics(df, "s", "y").first()
    assert row["test_auc"] == pytest.approx(brute_auc(scores, labels), abs=1e-12)
    assert row["test_avg_precision"] == pytest.approx(brute_average_precision(scores, labels), abs=1e-12)


def test_auc_edge_cases(spark):
    def auc(rows):
        return metrics.roc_auc(spark.createDataFrame(rows, "s double, y int"), "s", "y").first()[0]

    assert auc([(0.5, 1), (0.5, 0), (0.5, 1)]) == 0.5
    assert auc([(0.9, 1), (0.1, 0)]) == 1.0
    assert auc([(0.1, 1), (0.9, 0)]) == 0.0
    assert auc([(0.1, 1), (0.9, 1)]) is None


def test_auc_is_invariant_under_monotone_maps(spark):
    rng = np.random.default_rng(5)
    rows = [(float(a), int(b)) for a, b in zip(rng.uniform(0, 1, 400), rng.integers(0, 2, 400))]
    df = spark.createDataFrame(rows, "s double, y int")
    assert metrics.roc_auc(df, "s", "y").first() == metrics.roc_auc(df.withColumn("s", F.exp("s")), "s", "y").first()


def test_medians_equal_numpy(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"a": rng.normal(size=4001), "b": rng.integers(0, 3, 4001).astype(float), "c": rng.lognormal(size=4001)})
    pdf.loc[:100, "c"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("c", F.when(~F.isnan("c"), F.col("c"))).withColumn("d", F.lit(None).cast("double"))
    got = ranking.exact_medians(df, ["a", "b", "c", "d"])
    assert got == {"a": np.median(pdf["a"]), "b": np.median(pdf["b"]), "c": np.nanmedian(pdf["c"]), "d": None}
    tiny = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert ranking.exact_medians(tiny, ["x"]) == {"x": 2.5}


def test_median_survives_a_bad_sketch(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    assert ranking._search_brackets(df, {"x": (90.0, 95.0)}) == {}
    assert ranking._search_brackets(df, {"x": (float("-inf"), float("inf"))}) == {"x": 50.0}


@pytest.mark.parametrize("take", [0, 1, 137, 499, 500])
def test_pick_exactly(spark, take):
    df = spark.range(1000).select(F.concat(F.lit("K"), F.col("id")).alias("k"), (F.col("id") % 2).cast("int").alias("y"))
    picked = ranking.pick_exactly(df, "k", "y", F.lit(take), 3).groupBy("y").agg(F.count_if("picked").alias("n")).collect()
    assert {r["y"]: r["n"] for r in picked} == {0: take, 1: take}


def test_split_is_disjoint_complete_and_repeatable(spark):
    df = spark.range(999).select(F.concat(F.lit("K"), F.col("id")).alias("borrower_id"), (F.col("id") % 3 == 0).cast("int").alias("is_delinquent"))
    a = {r["borrower_id"]: r["split"] for r in sampling.stratified_split(df.repartition(1)).collect()}
    b = {r["borrower_id"]: r["split"] for r in sampling.stratified_split(df.repartition(9)).collect()}
    assert a == b and len(a) == 999 and set(a.values()) == {"train", "test"}
    balance = {r["split"]: r for r in sampling.class_balance(sampling.stratified_split(df)).collect()}
    assert balance["test"]["samples"] == 67 + 133


def test_split_never_sorts_all_rows(spark, domain):
    plan = sampling.stratified_split(domain["master"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_folds_cover_all(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("borrower_id"))
    sizes = [r["count"] for r in sampling.with_folds(df).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and min(sizes) > 500


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "is_delinquent int")
    sums = {r[0]: r[1] for r in sampling.with_class_weights(df).groupBy("is_delinquent").sum("weight").collect()}
    assert sums == pytest.approx({0: 5.0, 1: 5.0})


# --- selection --------------------------------------------------------------------------------


def best(spark, rows):
    df = spark.createDataFrame(rows, "model string, position int, test_f1 double, test_accuracy double")
    found = metrics.select_best(df).collect()
    return found[0]["model"] if found else None


def test_selection_rules(spark):
    assert best(spark, [("a", 0, 0.8, 0.9), ("b", 1, 0.8, 0.9)]) == "a"
    assert best(spark, [("a", 0, 0.8, 0.9), ("b", 1, 0.85, 1.0)]) == "a"
    assert best(spark, [("a", 0, 0.7, 0.9), ("b", 1, 0.85, 1.0)]) == "b"
    assert best(spark, [("a", 0, 0.0, 0.9), ("b", 1, 0.0, 0.9)]) is None


def test_class_metrics_without_hits(spark):
    df = spark.createDataFrame([(0, 1), (0, 0)], "p int, y int")
    row = metrics.class_metrics(df, "p", "y").first()
    assert row["test_precision"] == 0.0 and row["test_f1"] == 0.0 and row["test_accuracy"] == 0.5


# --- preprocessing ----------------------------------------------------------------------------


def test_mode_takes_the_smallest_of_a_tie(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "x string, y string")
    counts = preprocess.category_counts(df, ["x", "y"])
    assert {r["column"]: r["mode"] for r in preprocess.most_frequent(counts).collect()} == {"x": "a"}


def test_fit_and_transform(spark, domain):
    fitted = preprocess.fit_features(domain["master"], dt.date(2025, 1, 1))
    assert len(schemas.SCALED_FEATURES) == 36
    wide = fitted.transform(domain["master"])
    stats = wide.agg(*[F.avg(c).alias(c) for c in schemas.SCALED_FEATURES]).first().asDict()
    assert all(abs(v) < 1e-9 for v in stats.values())
    spread = wide.agg(*[F.stddev_pop(c).alias(c) for c in schemas.SCALED_FEATURES]).first().asDict()
    assert all(v == pytest.approx(1.0) or v == 0.0 for v in spread.values())
    assert wide.columns == ["borrower_id", "is_delinquent", *fitted.feature_names]
    again = preprocess.FeatureModel.from_json(fitted.to_json())
    assert again == fitted


def test_unknown_category_and_missing_columns_give_zeros(spark, domain):
    fitted = preprocess.fit_features(domain["master"], dt.date(2025, 1, 1))
    odd = domain["master"].limit(1).withColumn("major", F.lit("Alchemy"))
    row = fitted.transform(odd).first().asDict()
    assert all(v == 0.0 for n, v in row.items() if n.startswith("major_"))
    fewer = fitted.transform(domain["master"].drop("gpa", "max_days_late").limit(1)).first().asDict()
    assert fewer["gpa"] == 0.0 and fewer["max_days_late"] == 0.0


def test_null_band_is_its_own_category(spark, domain):
    nulls = domain["master"].withColumn("annual_income", F.when(F.col("dependents") > 0, F.col("annual_income")))
    fitted = preprocess.fit_features(nulls, dt.date(2025, 1, 1))
    assert fitted.categories["income_category"][-1] is None
    assert "income_category_nan" in fitted.feature_names
    row = fitted.transform(nulls.filter(F.col("annual_income").isNull()).limit(1)).first()
    assert row["income_category_nan"] == 1.0


def test_too_many_categories_is_an_error(spark, domain):
    crowded = domain["master"].withColumn("school_name", F.col("borrower_id"))
    with pytest.raises(ValueError, match="school_name"):
        preprocess.fit_features(crowded, dt.date(2025, 1, 1), max_categories=60)


def test_constant_column_scales_to_zero(spark, domain):
    flat = domain["master"].withColumn("age", F.lit(40))
    fitted = preprocess.fit_features(flat, dt.date(2025, 1, 1))
    assert fitted.transform(flat).select("age").distinct().collect()[0][0] == 0.0


# --- requests and outreach --------------------------------------------------------------------


def core(spark, rows):
    return spark.createDataFrame(
        rows,
        "borrower_id string, age int, credit_score_at_origination int, annual_income double, total_loan_amount double,"
        " loan_count int, total_monthly_payment double",
    )


def test_missing_core_field_is_named(spark):
    df = core(spark, [("A", 30, 700, 1.0, 1.0, 1, 1.0)]).drop("age")
    with pytest.raises(requests.MissingFieldsError, match="age"):
        requests.require_core_fields(df)


def test_defaults_only_fill_absent_fields(spark):
    df = core(spark, [("A", 30, 700, 60000.0, 20000.0, 2, 200.0)]).withColumn("total_payments_made", F.lit(1000.0)).withColumn("gpa", F.lit(None).cast("double"))
    row = requests.fill_request_defaults(df).first().asDict()
    assert row["total_scheduled"] == 1050.0 and row["gpa"] is None
    assert row["avg_loan_amount"] == 10000.0 and row["debt_to_income_ratio"] == pytest.approx(0.04)
    assert list(row)[0] == "borrower_id"
    assert list(row)[1:] == schemas.NUMERIC_FEATURES + schemas.CATEGORICAL_FEATURES


def test_zero_income_request_does_not_fail(spark):
    row = requests.fill_request_defaults(core(spark, [("A", 30, 700, 0.0, 20000.0, 0, 200.0)])).first()
    assert row["debt_to_income_ratio"] is None and row["avg_loan_amount"] is None


def test_quarantine_names_null_fields(spark):
    df = core(spark, [("A", 30, 700, 1.0, 1.0, 1, 1.0), ("B", None, 700, None, 1.0, 1, 1.0)])
    good, rejected = requests.quarantine(df)
    assert [r["borrower_id"] for r in good.collect()] == ["A"]
    row = rejected.first()
    assert row["error"] == "Null values found in core required fields: ['age', 'annual_income']"
    assert row["error_type"] == "ValueError"


def test_contract_limits(spark):
    rows = [(a, 700, 1.0, 1.0, 1, 1.0, "M") for a in (17, 18, 80, 81)] + [(30, 700, 1.0, 1.0, 1, 1.0, "X"), (30, 700, 1.0, 1.0, 1, 1.0, None)]
    df = spark.createDataFrame(
        [(f"B{i}", *r) for i, r in enumerate(rows)],
        "borrower_id string, age int, credit_score_at_origination int, annual_income double, total_loan_amount double,"
        " loan_count int, total_monthly_payment double, gender string",
    )
    found = {(r["borrower_id"], r["rule"]) for r in requests.contract_violations(df).collect()}
    assert found == {("B0", "age_minimum"), ("B3", "age_maximum"), ("B4", "gender_values")}
    counts = {r["rule"]: r["violations"] for r in requests.violation_counts(df).collect()}
    assert counts["age_minimum"] == 1 and counts["loan_count_minimum"] == 0


def test_rounding_happens_before_the_risk_floor(spark):
    df = spark.createDataFrame(
        [("A", 49.994, 0, "Low"), ("B", 49.996, 0, "Low"), ("C", 1.0, 1, "Low"), ("D", 1.0, 0, "High"), ("E", None, 0, None)],
        "borrower_id string, risk_score double, days_delinquent int, risk_category string",
    )
    listed = out_ops.high_risk(out_ops.outreach_projection(df, dt.datetime(2025, 1, 1)))
    assert {r["borrower_id"] for r in listed.collect()} == {"B", "C", "D"}


def test_contact_columns_pass_through(spark):
    df = spark.createDataFrame([("A", 1.0, "Phone", 9)], "borrower_id string, risk_score double, contact_preference string, other int")
    out = out_ops.outreach_projection(df, dt.datetime(2025, 1, 1))
    assert out.columns == ["borrower_id", "risk_score", "contact_preference", "processing_date"]


def test_summary_report_maps(spark):
    df = spark.createDataFrame(
        [("A", 60.0, "High", 0, "x", 3, 10.0, "CA"), ("B", 20.0, "Low", 5, "y", 2, 11.5, None), ("C", 30.0, None, 0, "x", 3, 1.0, "CA")],
        "borrower_id string, risk_score double, risk_category string, days_delinquent int, recommended_action string,"
        " priority_level int, total_owed double, state string",
    )
    row = out_ops.summary_report(df, dt.datetime(2025, 1, 1)).first()
    assert row["risk_distribution"] == {"High": 1, "Low": 1}
    assert row["action_priorities"] == {"2": 1, "3": 2} and row["state_distribution"] == {"CA": 2}
    assert row["contact_preferences"] == {}
    assert row["data_quality"]["missing_values"] == 2
    assert row["total_outstanding_balance"] == 22.5 and row["delinquent_borrowers"] == 1
    short = {r["metric"]: r["value"] for r in out_ops.short_summary(df).collect()}
    assert short == {"Total Borrowers": "3", "High Risk Count": "1", "Average Risk Score": "36.67", "Total Outstanding": "$22.50"}


def test_work_list_order(spark):
    df = spark.createDataFrame(
        [("A", 2, 10.0), ("B", 1, 5.0), ("C", 2, 90.0), ("D", 2, 90.0)], "borrower_id string, priority_level int, risk_score double"
    )
    assert [r["borrower_id"] for r in out_ops.work_list(df, 3).collect()] == ["B", "C", "D"]


def test_prediction_stats_with_latency(spark):
    df = spark.createDataFrame([("Low", 10.0, 5.0), ("Low", 20.0, 7.0)], "risk_category string, risk_score double, response_time_ms double")
    row = metrics.prediction_stats(df).first()
    assert row["mean_risk_score"] == 15.0 and row["mean_response_time_ms"] == 6.0


def test_request_bodies_of_all_shapes(spark):
    bodies = ['{"borrower_id":"A","age":30}', '[{"borrower_id":"B"},{"borrower_id":"C"}]', '{"data":[{"borrower_id":"D"}]}', "no json"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert [r["borrower_id"] for r in requests.parse_requests(df).collect()] == ["A", "B", "C", "D", None]


def test_running_counts_by_ranges_equal_those_by_slices(spark):
    from delinq.operators.ranking import cumulative_counts

    df = spark.range(3000).select(((F.col("id") * 7919) % 1000 / 10).alias("v"))
    counts = {"n": F.count(F.lit(1))}
    by_slices, by_ranges = (
        sorted(map(tuple, cumulative_counts(df, "v", counts, rows).collect())) for rows in (1_000_000, 10)
    )
    assert by_slices == by_ranges and by_ranges[-1][2] == 2997 and len(by_ranges) == 1000
    assert cumulative_counts(df.where("v < 0"), "v", counts).collect() == []
