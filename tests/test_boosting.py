from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from delinq.models.compiled import CompiledModel, compile_model, model_nodes, node_importance
from delinq.models.neighbours import nearest_neighbours
from delinq.models.second_order import SecondOrderBooster, quantile_edges
from delinq.operators.metrics import roc_auc

LABEL = "is_delinquent"


def sample(n=500, dims=4, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [round(rng.random(), 2) for _ in range(dims - 1)] + [1.0]  # ties, and a constant feature
        rows.append((f"B{i}", int(rng.random() < (0.85 if x[0] > 0.5 and x[1] > 0.3 else 0.15)), Vectors.dense(x)))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(sample(), ["borrower_id", LABEL, "features"])


def plain_trees(data, trees, depth, bins, eta, reg=1.0):
    """Exact second-order boosting in plain loops over the same cuts; leaves by row."""
    x = np.array([r[2].toArray() for r in data])
    y = np.array([r[1] for r in data], float)
    cuts = []
    for f in range(x.shape[1]):
        v = np.sort(x[:, f])
        ends = {v[-(-k * len(v) // bins) - 1] for k in range(1, bins)}
        cuts.append(sorted(e for e in ends if e < v[-1]))
    margin = np.zeros(len(y))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)

        def grow(idx, level, g=g, h=h):
            gs, hs = g[idx].sum(), h[idx].sum()
            best = None
            if level < depth:
                for f, ends in enumerate(cuts):
                    for e in ends:
                        left = idx[x[idx, f] <= e]
                        gl, hl = g[left].sum(), h[left].sum()
                        gr, hr = gs - gl, hs - hl
                        gain = (gl**2 / (hl + reg) + gr**2 / (hr + reg) - gs**2 / (hs + reg)) / 2
                        if hl >= 1 and hr >= 1 and gain > 0 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, f, e)
            if best is None:
                margin[idx] += -eta * gs / (hs + reg)
                return
            low = x[idx, best[1]] <= best[2]
            grow(idx[low], level + 1)
            grow(idx[~low], level + 1)

        grow(np.arange(len(y)), 0)
    return margin


def test_equals_plain_boosting(spark, rows):
    model = SecondOrderBooster(labelCol=LABEL, maxIter=10, maxDepth=2, maxBins=16, stepSize=0.4).fit(rows)
    got = {r[0]: r[1] for r in model.transform(rows).select("borrower_id", vector_to_array("rawPrediction")[1]).collect()}
    want = plain_trees(sample(), 10, 2, 16, 0.4)  # more trees than margins stay pending
    assert [got[r[0]] for r in sample()] == pytest.approx(list(want), abs=1e-6)


def test_same_trees_under_any_partitioning(rows):
    fit = lambda n: SecondOrderBooster(labelCol=LABEL, maxIter=4, maxDepth=3, subsamplingRate=0.7, featureRate=0.6).fit(rows.repartition(n)).nodes
    assert fit(1) == fit(7)


def test_samples_change_trees_and_quality_holds(rows):
    booster = SecondOrderBooster(labelCol=LABEL, maxIter=6, maxDepth=2, subsamplingRate=0.5, seed=1)
    first, second = booster.fit(rows), booster.copy({booster.seed: 2}).fit(rows)
    assert first.nodes != second.nodes
    scored = first.transform(rows).withColumn("p", vector_to_array("probability")[1])
    assert roc_auc(scored, "p", LABEL).first()["roc_auc"] > 0.8
    assert scored.where((F.col("p") > 0.5) != (F.col("prediction") == 1)).count() == 0


def test_limits_of_growth(spark, rows):
    none = SecondOrderBooster(labelCol=LABEL, maxIter=1, maxDepth=3, minSplitGain=1e9).fit(rows)
    assert len(none.nodes) == 1 and none.featureImportances.toArray().sum() == 0
    heavy = SecondOrderBooster(labelCol=LABEL, maxIter=1, maxDepth=6, minChildWeight=40.0).fit(rows)
    assert all(n[8] >= 40 for n in heavy.nodes) and all(n[2] != 3 for n in heavy.nodes)
    doubled = SecondOrderBooster(labelCol=LABEL, maxIter=1, maxDepth=1, weightCol="w").fit(rows.withColumn("w", F.lit(2.0)))
    assert doubled.nodes[0][8] == pytest.approx(2 * none.nodes[0][8])
    with pytest.raises(ValueError, match="no rows"):
        SecondOrderBooster(labelCol=LABEL).fit(rows.limit(0))


def test_quantile_ends(spark):
    df = spark.createDataFrame([(str(i), [float(i % 10), 5.0]) for i in range(100)], "key string, x array<double>")
    ends = quantile_edges(df, 100, 4, 1)
    assert ends[0].tolist() == [2.0, 4.0, 7.0] and ends[1].tolist() == []


def test_store(spark, rows, tmp_path):
    model = SecondOrderBooster(labelCol=LABEL, maxIter=2, maxDepth=2).fit(rows)
    PipelineModel([model]).write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert (again.nodes, again.base, again.n_features, again.getLabelCol()) == (model.nodes, model.base, 4, LABEL)


KINDS = {
    "linear": lambda: LogisticRegression(labelCol=LABEL),
    "forest": lambda: RandomForestClassifier(labelCol=LABEL, numTrees=5, maxDepth=5, seed=1),
    "boosted": lambda: GBTClassifier(labelCol=LABEL, maxIter=4, maxDepth=3, seed=1),
    "second": lambda: SecondOrderBooster(labelCol=LABEL, maxIter=4, maxDepth=3),
    "stumps": lambda: RandomForestClassifier(labelCol=LABEL, numTrees=2, maxDepth=0, seed=1),
}


@pytest.mark.parametrize("kind", KINDS)
def test_compiled_equals_transform(spark, rows, kind):
    model = KINDS[kind]().fit(rows)
    compiled = CompiledModel.from_json(compile_model(spark, model).to_json())
    both = model.transform(rows).select(
        vector_to_array("probability")[1].alias("a"), compiled.probability(vector_to_array("features")).alias("b")
    )
    assert both.where("b is null or abs(a - b) > 1e-12").count() == 0
    empty = spark.sql("select cast(null as array<double>) as x").select(compiled.probability(F.col("x")).alias("p"))
    assert empty.first().p is None
    if hasattr(model, "featureImportances") and model.featureImportances.toArray().sum():
        own = {r.feature: r.importance for r in node_importance(model_nodes(spark, model), kind).collect()}
        assert [own.get(i, 0.0) for i in range(4)] == pytest.approx(model.featureImportances.toArray().tolist())


def test_features_are_worked_out_once_a_row(spark, rows):
    """A feature expression must not move into the steps from node to node."""
    compiled = compile_model(spark, RandomForestClassifier(labelCol=LABEL, numTrees=3, maxDepth=3, seed=4).fit(rows))
    wide = spark.range(3).select(F.array(*[F.col("id") * F.lit(7.53125 + i) for i in range(4)]).alias("x"))
    text = wide.select(compiled.probability(F.col("x")).alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert text.rindex("7.53125") < text.index("aggregate(")


def test_incomplete_node_table_is_refused(spark, rows):
    nodes = model_nodes(spark, RandomForestClassifier(labelCol=LABEL, numTrees=1, maxDepth=2).fit(rows))
    with pytest.raises(ValueError, match="lacks node 1"):
        CompiledModel.of(nodes.where("node <> 1"), "forest")


def test_neighbour_cells_rule_out_most_pairs(spark):
    """Clusters in 64 dimensions: exact neighbours from less than a tenth of all distances."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 64)) * 4
    x = centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 64)) * 0.3
    points = spark.createDataFrame([(f"P{i:05d}", v.tolist()) for i, v in enumerate(x)], "id string, x array<double>")
    stats = {}
    got = {r["id"]: [(f["other"], f["dist"]) for f in r["found"]] for r in nearest_neighbours(points, 5, 100, stats=stats).collect()}
    assert stats["all"] == 3000**2 and stats["pairs"] < stats["all"] / 10
    for i in range(0, 3000, 37):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[i] = np.inf
        order = np.argsort(d)[:5]
        assert [o for o, _ in got[f"P{i:05d}"]] == [f"P{j:05d}" for j in order]
        assert [v for _, v in got[f"P{i:05d}"]] == pytest.approx(list(d[order]))


def test_queries_travel_once_for_many_blocks(spark):
    """Without clusters nearly all blocks are open; a query still goes to each region only once."""
    x = np.random.default_rng(9).normal(size=(400, 16))
    points = spark.createDataFrame([(f"P{i:03d}", v.tolist()) for i, v in enumerate(x)], "id string, x array<double>")
    stats = {}
    got = {r["id"]: [f["other"] for f in r["found"]] for r in nearest_neighbours(points, 5, 10, stats=stats).collect()}
    assert stats["visits"] <= 400 < stats["pairs"]
    for i in range(400):
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        assert got[f"P{i:03d}"] == [f"P{j:03d}" for j in np.argsort(d)[:5]]
