"""Plans of the main operators: what is read, shuffled and pushed down."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from delinq.operators import outreach as out_ops
from delinq.operators import payments as pay_ops
from delinq.operators.master import lookup_one
from delinq.plans.queries import catalog, models
from delinq.session import materialise
from delinq.sources import adapters


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(domain):
    return materialise(domain["payments"], "payments")


def test_features_need_one_scan_and_one_shuffle(stored):
    main = plan(pay_ops.delinquency_features(stored)).split("+- Subquery")[0]
    text = plan(pay_ops.delinquency_features(stored))
    assert text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text and "Window" not in text
    assert "HashAggregate" in main
    # The identifiers of payment and loan are never read.
    for schema in re.findall(r"ReadSchema: (\S+)", text):
        assert "payment_id" not in schema and "loan_id" not in schema


def test_cutoff_reads_only_the_date(stored):
    text = plan(pay_ops.recent_stats(stored))
    assert "ReadSchema: struct<payment_date:timestamp_ntz>" in text


def test_lookup_and_risk_filter_reach_the_scan(domain):
    text = plan(lookup_one(domain["master"], "BOR_000001"))
    assert "PushedFilters: [IsNotNull(borrower_id), EqualTo(borrower_id,BOR_000001)]" in text
    listed = domain["master"].select(
        "borrower_id", "risk_score", F.lit(0).alias("days_delinquent"), F.lit("Low").alias("risk_category")
    )
    text = plan(out_ops.high_risk(materialise(listed, "listed")))
    assert "PushedFilters: [Or(Or(GreaterThanOrEqual(risk_score,50.0)" in text


# Queries whose plan is built without running a model fit or a write.
LAZY = [n for n in entry.queries() if re.match(r"[b-f]\d|i\d|h8|j2_(metric_windows|sliding|sessions)", n) and n not in ("d10_summary_report", "d15_impute", "d17_scale", "d18_balance", "e3_split")]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, small, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(entry.queries()[name](spark, small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "Python" not in text and "ArrowEval" not in text


def _counted(monkeypatch, module, name):
    calls, real = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *args, **kwargs: calls.append(name) or real(*args, **kwargs))
    return calls


@pytest.mark.parametrize("query", ["a11_summary_sink", "a12_output_runs"])
def test_outreach_runs_derive_payments_once(spark, small, monkeypatch, query):
    derived = _counted(monkeypatch, adapters, "payments")
    assert entry.queries()[query](spark, small).count() > 0
    assert len(derived) == 1


def test_model_queries_share_payments_and_master(spark, small, monkeypatch):
    models._masters.clear()
    derived = _counted(monkeypatch, adapters, "payments")
    payments, master = models._master(spark, small)
    assert models._master(spark, small)[1] is master and len(derived) == 1
    assert "Join" not in plan(payments) and "Join" not in plan(master)


def test_warehouse_tables_are_derived_once(spark, small):
    frames = catalog._frames(spark, small, written=True)
    for name in ("student_loan_payments", "student_loan_delinquency_features", "student_loan_master_dataset"):
        assert "Join" not in plan(frames[name]) and "Aggregate" not in plan(frames[name])
