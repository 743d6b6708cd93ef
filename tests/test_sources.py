from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delinq import schemas
from delinq.operators import outreach as out_ops
from delinq.plans import jobs
from delinq.sources import catalog, files

AS_OF = dt.datetime(2025, 1, 1)


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_contracts():
    widths = {name: len(schema) for name, schema in schemas.TABLES.items()}
    assert list(widths.values()) == [10, 8, 10, 8, 14, 36, 36]
    assert set(schemas.MASTER.names) == set(schemas.REALISTIC.names)
    assert len(schemas.NUMERIC_FEATURES) == 25 and len(schemas.CATEGORICAL_FEATURES) == 9
    assert len(schemas.OUTREACH_COLUMNS) == 25


def test_conform_order_types_nan_and_report(spark, domain):
    messy = domain["borrowers"].select(*reversed(domain["borrowers"].columns), F.lit(1).alias("x")).drop("state")
    messy = messy.withColumn("annual_income", F.lit(float("nan")))
    report = catalog.column_report(messy, schemas.BORROWERS)
    assert report.missing == ["state"] and report.extra == ["x"]
    out = catalog.conform(messy, schemas.BORROWERS)
    assert out.columns == [c for c in schemas.BORROWERS.names if c != "state"]
    assert out.filter(F.col("annual_income").isNotNull()).isEmpty()


def test_csv_header_decides_the_columns(spark, domain, tmp_path):
    shuffled = domain["education"].select(*reversed(domain["education"].columns), F.lit("z").alias("extra"))
    path = files.write_csv(shuffled, str(tmp_path / "e.csv"))
    back = files.read_records(spark, path, schemas.EDUCATION)
    assert back.columns == schemas.EDUCATION.names
    assert same(domain["education"], back)


def test_json_array_and_lines(spark, tmp_path):
    records = [{"borrower_id": "A", "gpa": 3.5}, {"borrower_id": "B", "gpa": None}]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=2))
    back = files.read_records(spark, str(tmp_path / "a.json"), schemas.EDUCATION)
    assert {(r["borrower_id"], r["gpa"]) for r in back.collect()} == {("A", 3.5), ("B", None)}
    path = files.write_json(back, str(tmp_path / "lines.json"))
    assert same(back, files.read_json(spark, path, schemas.EDUCATION, array=False))


def test_unknown_suffix_is_an_error(spark, domain):
    with pytest.raises(ValueError, match="Unsupported file format"):
        files.read_records(spark, "/tmp/x.parquet", schemas.EDUCATION)
    with pytest.raises(ValueError, match="Unsupported file format"):
        files.write_records(domain["education"], "/tmp/x.xml")


def test_iso_dates(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 6, 7, 8, 9),)], "t timestamp")
    assert files.with_iso_dates(df).first()[0] == "2024-05-06T07:08:09.000"


def test_load_all_and_verify(spark, domain, tmp_path):
    frames = {"student_loan_borrowers": domain["borrowers"], "student_loan_payments": domain["payments"]}
    summary = catalog.load_all(spark, "loans_db", frames, str(tmp_path / "db"), buckets=4)
    counts = {r["table_name"]: r["row_count"] for r in summary.collect()}
    assert len(counts) == 8 and counts["student_loan_borrowers"] == domain["borrowers"].count()
    assert counts["student_loan_education"] == 0
    assert counts["TOTAL"] == sum(v for k, v in counts.items() if k != "TOTAL")
    check = catalog.verify_load(spark, "loans_db", {"student_loan_borrowers": counts["student_loan_borrowers"], "student_loan_loans": 5})
    assert {r["table_name"]: r["complete"] for r in check.collect()} == {"student_loan_borrowers": True, "student_loan_loans": False}
    assert spark.table("loans_db.student_loan_payments").schema.names == schemas.PAYMENTS.names


def test_clustered_tables_join_without_shuffle(spark, domain, tmp_path):
    frames = {f"student_loan_{n}": domain[n] for n in ("borrowers", "education", "payments")}
    catalog.load_all(spark, "clustered_db", frames, str(tmp_path / "db2"), buckets=4)
    own, school = (spark.table(f"clustered_db.student_loan_{n}") for n in ("borrowers", "education"))
    plan = own.hint("merge").join(school, "borrower_id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    # Payments are never clustered: one borrower may hold most rows.
    described = spark.sql("DESCRIBE EXTENDED clustered_db.student_loan_payments").collect()
    assert not [r for r in described if r["col_name"] == "Num Buckets"]


def test_csv_load_skips_missing_and_caps_rows(spark, domain, tmp_path):
    catalog.recreate_database(spark, "csv_db", str(tmp_path / "db3"))
    path = files.write_csv(catalog.conform(domain["payments"], schemas.PAYMENTS), str(tmp_path / "p.csv"))
    paths = {"student_loan_payments": path, "student_loan_loans": str(tmp_path / "none.csv")}
    with pytest.warns(UserWarning, match="not found"):
        reports = catalog.load_csv_tables(spark, "csv_db", paths)
    assert list(reports) == ["student_loan_payments"]
    assert spark.table("csv_db.student_loan_payments").count() == 100


def test_outreach_run_writes_all_outputs(spark, domain, tmp_path):
    scored = jobs.with_rule_scores(domain["master"])
    result = jobs.run_outreach(scored, domain["payments"], str(tmp_path / "run"), AS_OF)
    expected = out_ops.high_risk(jobs.outreach_table(scored, domain["payments"], AS_OF))
    assert result.status == "success" and result.records_processed == domain["master"].count()
    assert result.high_risk_identified == expected.count()
    assert all("run_ts=20250101_000000" in p for p in result.output_files.values())
    back = files.read_json(spark, result.output_files["json"], expected.schema, array=False)
    assert same(expected, back)
    as_csv = files.read_csv(spark, result.output_files["csv"], expected.schema)
    assert as_csv.count() == expected.count()
    summary = spark.read.json(result.output_files["summary"]).first()
    assert summary["total_borrowers"] == expected.count()
    pruned = spark.read.json(str(tmp_path / "run" / "summary")).filter("run_ts = '20250101_000000'")
    assert pruned.count() == 1


def test_checked_csv_keeps_every_fault(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    schema = T.StructType().add("id", "string").add("n", "integer").add("x", "double").add("absent", "integer")
    with open(path, "w") as f:
        f.write("x,id,n,other\n1.5,a,3,o\nNaN,b,,o\nbad,c,4.5,o\n2,d,7\n3,e,8,o,more\n")
    rows, rejects = files.read_checked(spark, path, schema, "id")
    assert sorted(map(tuple, rows.collect())) == [("a", 3, 1.5, None), ("b", None, None, None), ("c", None, None, None)]
    assert sorted(map(str, map(tuple, rejects.collect()))) == sorted(map(str, [
        ("c", "n", "4.5", "not a int"), ("c", "x", "bad", "not a double"),
        (None, None, "2,d,7", "unreadable record"), (None, None, "3,e,8,o,more", "unreadable record"),
    ]))
    with pytest.raises(ValueError):
        files.read_checked(spark, str(tmp_path / "in.txt"), schema, "id")


def test_checked_json_keeps_every_fault(spark, tmp_path):
    path = str(tmp_path / "in.json")
    with open(path, "w") as f:
        f.write('{"id": "a", "n": 3}\n{"id": "b", "n": "x", "more": [1]}\nnot json\n{"id": "c", "n": null}\n')
    schema = T.StructType().add("id", "string").add("n", "integer")
    rows, rejects = files.read_checked(spark, path, schema, "id")
    assert sorted(map(tuple, rows.collect())) == [("a", 3), ("b", None), ("c", None)]
    assert sorted(map(str, map(tuple, rejects.collect()))) == sorted(map(str, [("b", "n", "x", "not a int"), (None, None, "not json", "unreadable record")]))


def test_a_failed_output_set_is_not_seen(spark, tmp_path, monkeypatch):
    """A crash between two writes leaves the set before it whole and the one committed last."""
    root, run = str(tmp_path / "out"), dt.datetime(2025, 1, 1)
    frame = lambda n: spark.range(n).select(F.col("id").cast("string").alias("borrower_id"))
    first = files.write_output_set(frame(3), frame(1), frame(1), root, run)
    assert files.committed_paths(spark, root) == first

    def fail(df, path):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(files, "write_json", fail)
        with pytest.raises(OSError):
            files.write_output_set(frame(9), frame(1), frame(1), root, run)
    assert files.committed_paths(spark, root) == first
    assert spark.read.json(files.committed_paths(spark, root)["json"]).count() == 3
    second = files.write_output_set(frame(5), frame(1), frame(1), root, run)
    other = files.write_output_set(frame(6), frame(1), frame(1), root, dt.datetime(2024, 1, 1))
    assert files.committed_paths(spark, root) == other and files.committed_paths(spark, root, "20250101_000000") == second
    assert files.committed_sets(spark, root).count() == 2
    with pytest.raises(ValueError, match="no committed run"):
        files.committed_paths(spark, root, "20000101_000000")
