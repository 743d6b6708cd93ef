"""Steps that must not do more than their rows need, with results as before."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from delinq.models import neighbours, oversample, scoring, second_order
from delinq.operators import preprocess, sampling
from delinq.sources import adapters


def test_neighbours_at_equal_distances_are_ordered_by_id():
    """More points at the same distance than are asked for: the smallest ids count, whatever the first bound was."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2, size=(4500, 8)).astype(float)
    ids = np.array([f"{i:05d}" for i in rng.permutation(len(x))])
    some = pd.DataFrame({"id": ids, "x": list(x)})
    asked = some.iloc[:50]
    got = neighbours._nearest(asked, some, 5)
    for own, point, found in zip(asked["id"], asked["x"], got):
        dist = np.sqrt(((x - point) ** 2).sum(1))
        assert found == sorted((float(d), i) for d, i in zip(dist, ids) if i != own)[:5]


def test_bounds_hide_no_neighbour_far_from_the_origin():
    rng = np.random.default_rng(4)
    for x in (rng.normal(size=(300, 6)) * 1e-3 + 1e4, rng.normal(size=(300, 5)) * 1e20):
        ids = np.array([f"{i:05d}" for i in range(len(x))])
        targets = neighbours._Targets(x, ids)
        true = [sorted((float(d), i) for d, i in zip(np.sqrt(((x - p) ** 2).sum(1)), ids) if i != own)[:5] for own, p in zip(ids, x)]
        reach = np.array([t[-1][0] for t in true])
        assert targets.near(x, ids, reach, 5) == true


def _shuffled_rows(plan) -> int:
    """Rows that all exchanges of a plan wrote, once it has run."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _shuffled_rows(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return _shuffled_rows(plan.plan())
    metric = plan.metrics().get("shuffleRecordsWritten")
    children = plan.children()
    return (metric.get().value() if metric.isDefined() else 0) + sum(_shuffled_rows(children.apply(i)) for i in range(children.size()))


def test_neighbours_shuffle_and_write_each_point_once(spark, monkeypatch):
    """Nothing rules out a block here, so every query meets every region; rows moved and written stay as many as points."""
    n = 300
    x = np.random.default_rng(12).normal(size=(n, 16))
    points = spark.createDataFrame([(f"P{i:03d}", v.tolist()) for i, v in enumerate(x)], "id string, x array<double>")
    monkeypatch.setattr(neighbours, "REGION_ROWS", 20)
    written = []
    monkeypatch.setattr(neighbours, "materialise", lambda df, name, keep=neighbours.materialise: written.append(keep(df, name)) or written[-1])
    stats = {}
    found = neighbours.nearest_neighbours(points, 5, 20, stats=stats)
    got = {r["id"]: [f["other"] for f in r["found"]] for r in found.collect()}
    for i in range(n):
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        assert got[f"P{i:03d}"] == [f"P{j:03d}" for j in np.argsort(d)[:5]]
    assert stats["visits"] > 10 * n  # every other region, a few excepted
    assert _shuffled_rows(found._jdf.queryExecution().executedPlan()) <= n
    assert all(w.count() <= n for w in written)


def test_only_rows_with_copies_look_for_neighbours(spark, monkeypatch):
    """Three rows are missing, so three search among all; the new rows are those of a search by all."""
    rng = np.random.default_rng(13)
    rows = [(f"{c}{i}", c, array) for c, n in ((0, 103), (1, 100)) for i, array in enumerate(rng.normal(c, 1, size=(n, 3)).tolist())]
    df = spark.createDataFrame(rows, "borrower_id string, is_delinquent int, features array<double>").withColumn("features", array_to_vector("features"))
    made = lambda: sorted((r[0], tuple(r[2].toArray())) for r in oversample.oversample_minority(df, block_rows=20).collect() if "#" in r[0])
    stats = {}
    search = oversample.nearest_neighbours
    monkeypatch.setattr(oversample, "nearest_neighbours", lambda *a, **options: search(*a, stats=stats, **options))
    some = made()
    assert len(some) == 3 and stats["all"] == 3 * 100
    monkeypatch.setattr(oversample, "nearest_neighbours", lambda points, k, block_rows, seed, asking: search(points, k, block_rows, seed))
    assert made() == some


def test_parts_are_cut_before_their_features_are_worked_out(spark, domain):
    split = sampling.stratified_split(domain["master"])
    features = preprocess.fit_features(split, dt.date(2025, 1, 1))
    both = scoring.training_frame(split, features)
    for part, name in zip(both, ("train", "test")):
        lines = part._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assembled = next(i for i, line in enumerate(lines) if "UDF(struct(" in line)
        assert not any(f"= {name})" in line for line in lines[:assembled])
        assert part.count() == split.where(F.col("split") == name).count()


def test_payments_shuffle_only_what_is_asked_for(spark, tmp_path):
    """The delay is worked out before the join; rows are those of the SQL, with repeated and null keys too."""
    lines = [(k, n, 7 * k + n, 3 * k, 10.0 * n, f"1995-01-0{n}") for k in (1, 2, 5, 99_999_999, 100_000_000) for n in (1, 1, 2, 3)] + [(None, 1, 1, 1, 1.0, "1995-01-01"), (6, 1, 1, 1, 1.0, "1995-01-01")]
    columns = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_shipdate string"
    spark.createDataFrame(lines, columns).withColumn("l_shipdate", F.to_timestamp("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(1, 3), (2, 999_999), (2, 999_999), (5, 1_000_000), (99_999_999, None), (100_000_000, 4), (None, 5)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = adapters.payments(spark, str(tmp_path))
    tables = {n: adapters.table(spark, str(tmp_path), n) for n in ("lineitem", "orders")}
    want = spark.sql(adapters.PAYMENTS_SQL, **tables)
    assert got.schema == want.schema
    assert got.count() == want.count() == 24
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    plan = got.drop("payment_id")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(plan) if "Join" in line)
    assert "l_partkey" not in plan[join + 1] and "days_late" in plan[join + 1]


def test_histograms_hold_only_the_bins_of_each_feature(monkeypatch):
    """Sums by node, feature and bin against plain loops, with features of 2 and of 200 bins; no sum has room for more."""
    rng = np.random.default_rng(6)
    widths, n = [2, 200, 2, 1], 500
    bins = np.stack([rng.integers(0, w, n) for w in widths], axis=1).astype(np.uint8)
    y = rng.integers(0, 2, n).astype(float)
    columns = [pa.array(np.arange(n)), pa.array(y), pa.array(np.ones(n)), pa.array([b.tobytes() for b in bins], pa.binary()), pa.array(np.zeros(n))]
    batch = pa.RecordBatch.from_arrays(columns, names=["key", "y", "w", "bins", "margin"])
    tree = second_order.Tree()
    tree.add(0.0, 0.0)
    tree.feature[0], tree.cut[0] = 1, 80
    tree.left[0], tree.right[0] = tree.add(0.0, 0.0), tree.add(0.0, 0.0)
    longest = []
    count = np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, w=None, size=0: longest.append(size) or count(x, w, size))
    run = second_order._histograms([], tree, [1, 2], [0, 1, 3], widths, 0.25, 0, 1.0, 42)
    (found,) = run(iter([batch, batch]))
    want: dict[tuple, list[int]] = {}
    for own, label in zip(bins, y):
        for f in (0, 1, 3):
            cell = want.setdefault((1 if own[1] <= 80 else 2, f, int(own[f])), [0, 0])
            cell[0] += 2 * round((0.5 - label) / 0.25)
            cell[1] += 2
    assert {(r["node"], r["feature"], r["bin"]): [r["g"], r["h"]] for r in found.to_pylist()} == want
    assert sorted(set(longest)) == [2, 4, 400]
