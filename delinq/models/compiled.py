"""Fitted models as node or coefficient tables, and as one native column expression each.

A model is saved, its stored nodes are read back as a table, and that table becomes one literal that a column expression
walks: no Python function, no model object and no vector column is needed to score. Models are a few thousand numbers,
whatever the training data, so the literal travels with the plan.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delinq.session import scratch_path

NODES = "tree int, node int, feature int, threshold double, left int, right int, value double, gain double, cover double"
_TREES = "array<struct<depth:int,feature:array<int>,threshold:array<double>,left:array<int>,right:array<int>,value:array<double>>>"
LEAF = -1


def model_nodes(spark: SparkSession, model: Model) -> DataFrame:
    """The nodes of a fitted model, ``NODES``.

    Trees: ``left`` and ``right`` are nodes of the same tree (-1 at a leaf), rows with feature <= threshold go left, the
    value of a leaf is what the tree adds. A linear model is one row a feature (value: its coefficient) and one with
    feature -1 for the intercept, all in tree 0.
    """
    if hasattr(model, "coefficients"):
        rows = [(0, i, i, None, LEAF, LEAF, float(v), None, None) for i, v in enumerate(model.coefficients.toArray())]
        rows.append((0, len(rows), -1, None, LEAF, LEAF, float(model.intercept), None, None))
        return spark.createDataFrame(rows, NODES)
    if hasattr(model, "nodes"):
        return spark.createDataFrame(model.nodes, NODES)
    path = scratch_path(spark, "nodes")
    model.write().save(path)
    stored = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    stats = F.col("impurityStats")
    if type(model).__name__.startswith("RandomForest"):
        total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
        value, cover = stats[1] / total, total
        weight = F.lit(1.0)
    else:
        value, cover = F.col("prediction"), stats[0]
        weight = F.element_at(F.array(*[F.lit(float(w)) for w in model.treeWeights]), F.col("treeID") + 1)
    leaf = F.col("leftChild") < 0
    return stored.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.when(~leaf, F.col("split.featureIndex")).otherwise(-1).alias("feature"),
        F.when(~leaf, F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1))).alias("threshold"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.when(leaf, value * weight).alias("value"),
        F.when(~leaf, F.col("gain")).alias("gain"),
        cover.alias("cover"),
    )


def link_of(model: Model) -> dict[str, float | str]:
    """How the sum of a model's values becomes a probability."""
    if hasattr(model, "coefficients"):
        return {"kind": "linear"}
    if hasattr(model, "nodes"):
        return {"kind": "boosted", "base": float(model.base), "slope": 1.0}
    if type(model).__name__.startswith("RandomForest"):
        return {"kind": "forest"}
    return {"kind": "boosted", "base": 0.0, "slope": 2.0}


@dataclass(frozen=True)
class CompiledModel:
    """A scoring expression over an array of feature values."""

    kind: str
    trees: list[dict]
    coefficients: list[float]
    base: float = 0.0
    slope: float = 1.0

    @staticmethod
    def of(nodes: DataFrame, kind: str, base: float = 0.0, slope: float = 1.0) -> CompiledModel:
        """From a node table; its rows are the whole model and are fetched."""
        rows = nodes.orderBy("tree", "node").collect()
        if kind == "linear":
            own = sorted((r["feature"], r["value"]) for r in rows)
            return CompiledModel(kind, [], [v for f, v in own if f >= 0], own[0][1], 1.0)
        trees: dict[int, dict] = {}
        for r in rows:
            tree = trees.setdefault(r["tree"], {"depth": 0, **{k: [] for k in ("feature", "threshold", "left", "right", "value")}})
            if r["node"] != len(tree["feature"]):
                raise ValueError(f"tree {r['tree']} lacks node {len(tree['feature'])}")
            for name in ("feature", "left", "right"):
                tree[name].append(r[name])
            tree["threshold"].append(r["threshold"] or 0.0)
            tree["value"].append(r["value"] or 0.0)
        for tree in trees.values():
            level, depth = [0], 0
            while level := [c for i in level if tree["left"][i] >= 0 for c in (tree["left"][i], tree["right"][i])]:
                depth += 1
            tree["depth"] = depth
        return CompiledModel(kind, [trees[t] for t in sorted(trees)], [], base, slope)

    def margin(self, x: Column) -> Column:
        """The sum of the values for the array ``x`` of feature values."""
        # As the variable of a function ``x`` is worked out once a row; written into the steps below it would be at every node.
        return F.transform(F.array(x), self._sum)[0]

    def _sum(self, x: Column) -> Column:
        if self.kind == "linear":
            weights = F.from_json(F.lit(json.dumps(self.coefficients)), "array<double>")
            return F.aggregate(F.zip_with(x, weights, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v) + F.lit(self.base)
        trees = F.from_json(F.lit(json.dumps(self.trees)), _TREES)

        def leaf(tree: Column) -> Column:
            def step(at: Column, _: Column) -> Column:
                below = x[tree["feature"][at]] <= tree["threshold"][at]
                return F.when(tree["left"][at] < 0, at).when(below, tree["left"][at]).otherwise(tree["right"][at])

            return F.when(tree["depth"] == 0, 0).otherwise(F.aggregate(F.sequence(F.lit(1), tree["depth"]), F.lit(0), step))

        return F.aggregate(trees, F.lit(0.0), lambda total, tree: total + tree["value"][leaf(tree)]) + F.lit(self.base)

    def probability(self, x: Column) -> Column:
        """Probability of class 1, null without features."""
        total = self.margin(x)
        p = total / len(self.trees) if self.kind == "forest" else 1.0 / (1.0 + F.exp(-self.slope * total))
        return F.when(x.isNotNull(), p)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> CompiledModel:
        return CompiledModel(**json.loads(text))


def compile_model(spark: SparkSession, model: Model) -> CompiledModel:
    return CompiledModel.of(model_nodes(spark, model), **link_of(model))


def node_importance(nodes: DataFrame, kind: str) -> DataFrame:
    """feature, importance of a tree model from its nodes; features that no tree uses are left out.

    Forests and first-order boosting weigh the gain of each split by the rows it saw, a forest in shares of each tree;
    second-order boosting ("second") takes the mean gain of a feature's splits. All add up to 1.
    """
    splits = nodes.where("left >= 0")
    if kind == "second":
        sums = splits.groupBy("feature").agg(F.avg("gain").alias("v"))
    else:
        per_tree = splits.groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("cover")).alias("v"))
        if kind == "forest":
            whole = per_tree.groupBy("tree").agg(F.sum("v").alias("all"))
            per_tree = per_tree.join(whole, "tree").withColumn("v", F.try_divide("v", "all"))
        sums = per_tree.groupBy("feature").agg(F.sum("v").alias("v"))
    total = sums.agg(F.sum("v").alias("s"))
    return sums.select("feature", (F.col("v") / total.scalar()).alias("importance"))
