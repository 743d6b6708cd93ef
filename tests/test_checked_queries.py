"""Every registered query with check SQL must give the values DuckDB gives."""

from __future__ import annotations

import pytest
from compare import compare, duck

import __spark_entry__ as entry

CHECKED = "/root/testdata/sf0.01"
# Queries that fit models run in test_models on the smallest data set.
SLOW = {name for name in entry.queries() if name.startswith("h") and name not in ("h1_features", "h8_select_best", "h14_outreach_rules")}


@pytest.fixture(scope="module")
def con():
    return duck(CHECKED)


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n not in SLOW and n != "a13_model_store"])
def test_equals_duckdb(spark, con, name):
    good, text = compare(spark, con, name, CHECKED)
    assert good, text


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and len(rows[0]) == 14
