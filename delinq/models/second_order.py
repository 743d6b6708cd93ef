"""Second-order gradient boosting (Chen and Guestrin 2016) on histograms that Spark adds up.

Feature values are cut into quantile bins once. Each level of a tree is one aggregation: tasks add up the gradients and
hessians of their rows by (node, feature, bin), Spark sums those partial histograms, and running sums over the bins
of a feature give the gain of every cut. What reaches the driver is the best cut of each node. Sums are whole numbers
of a fixed unit, and row and column samples come from hashes, so trees are the same under any partitioning.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasLabelCol,
    HasMaxIter,
    HasPredictionCol,
    HasProbabilityCol,
    HasRawPredictionCol,
    HasSeed,
    HasStepSize,
    HasWeightCol,
)
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delinq.functions.numeric import uniform
from delinq.models.compiled import LEAF, NODES, CompiledModel
from delinq.session import materialise

# The functions of tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that the quantiles are taken from, chosen by hash.
QUANTILE_ROWS = 200_000
#: Trees after which the margins of the rows are written anew.
REFRESH = 8

_STATE = "key long, y double, w double, bins binary, margin double"


@dataclass
class Tree:
    """One tree; ``cut`` is the last bin that goes left, ``threshold`` its upper end."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)

    def add(self, value: float, cover: float) -> int:
        for name, v in (("feature", -1), ("cut", 0), ("threshold", 0.0), ("left", LEAF), ("right", LEAF), ("value", value), ("gain", 0.0), ("cover", cover)):
            getattr(self, name).append(v)
        return len(self.feature) - 1

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node each row of bins has come to."""
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        feature, cut, left, right = (np.array(v) for v in (self.feature, self.cut, self.left, self.right))
        while True:
            inner = left[at] >= 0
            if not inner.any():
                return at
            low = bins[rows, feature[at]] <= cut[at]
            at = np.where(inner, np.where(low, left[at], right[at]), at)


def quantile_edges(rows: DataFrame, n: int, bins: int, seed: int) -> list[np.ndarray]:
    """Upper ends of the bins of each feature but the last: values at ranks ceil(k n / bins) of the sampled rows.

    rows: key string, x array<double>. The sample is exact and whole up to ``QUANTILE_ROWS`` rows.
    """
    share = QUANTILE_ROWS / max(n, 1)
    some = rows if share >= 1 else rows.where(uniform(F.col("key"), seed) < share)
    cells = some.select(F.posexplode("x").alias("feature", "v"))

    def ends(key, table):
        v = np.sort(table.column("v").to_numpy())
        ranks = [-(-k * len(v) // bins) for k in range(1, bins)]
        found = np.unique(v[[r - 1 for r in ranks if r >= 1]])
        found = found[found < v[-1]]  # nothing lies above the largest value
        return pa.table({"feature": pa.array([key[0].as_py()], pa.int32()), "ends": pa.array([found.tolist()], pa.list_(pa.float64()))})

    found = cells.groupBy("feature").applyInArrow(ends, "feature int, ends array<double>").collect()
    out = {r["feature"]: np.array(r["ends"], np.float64) for r in found}
    return [out[f] for f in sorted(out)]


def _binned(edges: list[np.ndarray]):
    schema = pa.schema([("key", pa.int64()), ("y", pa.float64()), ("w", pa.float64()), ("bins", pa.binary()), ("margin", pa.float64())])

    def run(batches):
        for batch in batches:
            x = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1).astype(np.uint8)
            blobs = pa.array([row.tobytes() for row in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), blobs, batch.column(4)], schema=schema)

    return run


def _bins_of(batch: pa.RecordBatch) -> np.ndarray:
    blobs = batch.column("bins").to_pylist()
    return np.frombuffer(b"".join(blobs), np.uint8).reshape(len(blobs), -1)


def _margins(batch: pa.RecordBatch, bins: np.ndarray, trees: list[Tree]) -> np.ndarray:
    margin = batch.column("margin").to_numpy().copy()
    for tree in trees:  # one after the other: sums of doubles depend on the order
        margin += np.array(tree.value)[tree.place(bins)]
    return margin


def _with_margins(trees: list[Tree]):
    def run(batches):
        for batch in batches:
            margin = pa.array(_margins(batch, _bins_of(batch), trees))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), margin], names=batch.schema.names)

    return run


def _sampled(keys: np.ndarray, turn: int, rate: float, seed: int) -> np.ndarray:
    """Rows of a tree, from a hash of key, tree and seed."""
    x = keys.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) / (1 << 53) < rate


def _histograms(trees: list[Tree], tree: Tree, open_nodes: list[int], features: list[int], widths: list[int], unit: float, turn: int, rate: float, seed: int):
    """Gradient and hessian sums of a task's rows in the open nodes of a tree, in whole units.

    ``widths`` has the number of bins of each feature; a feature of two bins takes two sums a node.
    """
    schema = pa.schema([("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()), ("g", pa.int64()), ("h", pa.int64())])
    number = np.full(len(tree.feature), -1)
    number[open_nodes] = np.arange(len(open_nodes))

    def run(batches):
        sums = [(np.zeros(len(open_nodes) * widths[f]), np.zeros(len(open_nodes) * widths[f])) for f in features]
        for batch in batches:
            bins = _bins_of(batch)
            node = number[tree.place(bins)]
            used = node >= 0
            if rate < 1:
                used &= _sampled(batch.column("key").to_numpy(), turn, rate, seed)
            y, w = (batch.column(c).to_numpy() for c in ("y", "w"))
            p = 1.0 / (1.0 + np.exp(-_margins(batch, bins, trees)))
            g, h = (np.rint(v[used] / unit) for v in (w * (p - y), w * p * (1 - p)))
            at, own = node[used], np.ascontiguousarray(bins[used].T)
            for f, (g_sum, h_sum) in zip(features, sums):
                place = at * widths[f] + own[f]
                g_sum += np.bincount(place, g, len(g_sum))
                h_sum += np.bincount(place, h, len(h_sum))
        sizes = [len(g_sum) for g_sum, _ in sums]
        g_sum, h_sum = (np.concatenate(c) for c in zip(*sums))
        some = np.flatnonzero((g_sum != 0) | (h_sum != 0))
        k = np.repeat(np.arange(len(features)), sizes)[some]
        first = np.cumsum(sizes) - sizes
        node, bin_ = np.divmod(some - first[k], np.array([widths[f] for f in features])[k])
        columns = [np.array(open_nodes)[node], np.array(features)[k], bin_, g_sum[some], h_sum[some]]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(t.type.to_pandas_dtype())) for c, t in zip(columns, schema)], schema=schema)

    return run


def best_cuts(parts: DataFrame, unit: float, reg_lambda: float, min_split_gain: float, min_child_weight: float) -> DataFrame:
    """node, g, h (sums of the node) and best: its cut with the largest gain (ties: first feature, first bin), or null.

    parts: node, feature, bin, g, h in whole units; rows of one cell may repeat.
    """
    cells = parts.repartition("node", "feature").groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    own = Window.partitionBy("node", "feature")
    upto = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    real = lambda c: c.cast("double") * F.lit(unit)
    sums = cells.select(
        "node", "feature", "bin",
        *[real(F.sum(c).over(w)).alias(name) for c in ("g", "h") for w, name in ((upto, f"{c}l"), (own, c))],
    ).withColumns({"gr": real(F.lit(0)) + F.col("g") - F.col("gl"), "hr": F.col("h") - F.col("hl")})
    score = lambda g, h: F.col(g) * F.col(g) / (F.col(h) + F.lit(reg_lambda))
    gain = (score("gl", "hl") + score("gr", "hr") - score("g", "h")) * 0.5 - F.lit(min_split_gain)
    fits = (gain > 0) & (F.col("hl") >= min_child_weight) & (F.col("hr") >= min_child_weight)
    cut = F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "gl", "hl", "gr", "hr")
    return sums.groupBy("node").agg(F.max("g").alias("g"), F.max("h").alias("h"), F.max(F.when(fits, cut)).alias("best"))


class _BoostParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol):
    pass


class SecondOrderBooster(
    Estimator, _BoostParams, HasWeightCol, HasMaxIter, HasStepSize, HasSeed
):
    """Boosted trees for a 0/1 label from a vector column of features without nulls.

    Rows are told apart by ``keyCol`` if the input has it, for the samples only.
    """

    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, at most 256", TypeConverters.toInt)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of the rows of a tree", TypeConverters.toFloat)
    featureRate = Param(Params._dummy(), "featureRate", "share of the features of a tree", TypeConverters.toFloat)
    regLambda = Param(Params._dummy(), "regLambda", "L2 term on leaf weights", TypeConverters.toFloat)
    minSplitGain = Param(Params._dummy(), "minSplitGain", "least gain of a split", TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least hessian sum of a child", TypeConverters.toFloat)
    baseScore = Param(Params._dummy(), "baseScore", "probability before the first tree", TypeConverters.toFloat)
    keyCol = Param(Params._dummy(), "keyCol", "row key", TypeConverters.toString)

    @keyword_only
    def __init__(self, **kwargs):
        super().__init__()
        self._setDefault(
            maxIter=100, stepSize=0.3, maxDepth=6, maxBins=256, subsamplingRate=1.0, featureRate=1.0, regLambda=1.0,
            minSplitGain=0.0, minChildWeight=1.0, baseScore=0.5, keyCol="borrower_id", seed=42,
        )
        self._set(**self._input_kwargs)

    def _columns(self, n_features: int, turn: int) -> list[int]:
        rate = self.getOrDefault("featureRate")
        if rate >= 1:
            return list(range(n_features))
        draws = np.random.default_rng([self.getSeed(), turn]).random(n_features)
        return sorted(np.argsort(draws, kind="stable")[: max(1, round(rate * n_features))].tolist())

    def _rows(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(self.getFeaturesCol())
        key = self.getOrDefault("keyCol")
        key = F.col(key).cast("string") if key in dataset.columns else F.concat_ws(",", x.cast("array<string>"))
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet("weightCol") else F.lit(1.0)
        return dataset.select(key.alias("key"), F.col(self.getLabelCol()).cast("double").alias("y"), weight.alias("w"), x.alias("x"))

    def _fit(self, dataset: DataFrame) -> SecondOrderModel:
        get = self.getOrDefault
        rows = self._rows(dataset)
        facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max("w").alias("w"), F.max(F.size("x")).alias("d")).first()
        if not facts["n"]:
            raise ValueError("no rows to train on")
        n, d = facts["n"], facts["d"]
        # Sums of n rows stay whole numbers below 2^52 in a double, and below 2^63 over all tasks.
        unit = 2.0 ** -min(40, 51 - math.ceil(math.log2(max(2.0, n * facts["w"]))))
        base = math.log(get("baseScore") / (1 - get("baseScore")))
        edges = quantile_edges(rows, n, min(256, get("maxBins")), self.getSeed())
        keyed = rows.select(F.xxhash64("key").alias("key"), "y", "w", "x", F.lit(base).alias("margin"))
        state = materialise(keyed.mapInArrow(_binned(edges), _STATE), "boosting")
        trees: list[Tree] = []
        pending: list[Tree] = []
        for turn in range(self.getMaxIter()):
            tree = self._grow(state, pending, self._columns(d, turn), edges, unit, turn)
            trees.append(tree)
            pending.append(tree)
            if len(pending) == REFRESH and turn + 1 < self.getMaxIter():
                state = materialise(state.mapInArrow(_with_margins(pending), _STATE), "boosting")
                pending = []
        nodes = [
            (t, i, tree.feature[i], tree.threshold[i], tree.left[i], tree.right[i], tree.value[i], tree.gain[i], tree.cover[i])
            for t, tree in enumerate(trees)
            for i in range(len(tree.feature))
        ]
        return self._copyValues(SecondOrderModel(nodes, base, d))

    def _grow(self, state: DataFrame, pending: list[Tree], features: list[int], edges: list[np.ndarray], unit: float, turn: int) -> Tree:
        get = self.getOrDefault
        reg, eta = get("regLambda"), self.getStepSize()
        tree, widths = Tree(), [len(e) + 1 for e in edges]
        open_nodes = [tree.add(0.0, 0.0)]
        for _ in range(get("maxDepth")):
            sums = _histograms(pending, tree, open_nodes, features, widths, unit, turn, get("subsamplingRate"), self.getSeed())
            parts = state.mapInArrow(sums, "node int, feature int, bin int, g long, h long")
            found = best_cuts(parts, unit, reg, get("minSplitGain"), get("minChildWeight")).collect()
            open_nodes = []
            for row in sorted(found, key=lambda r: r["node"]):  # at most a row a node
                at, best = row["node"], row["best"]
                tree.value[at], tree.cover[at] = -eta * row["g"] / (row["h"] + reg), row["h"]
                if best is None:
                    continue
                f, cut = -best["f"], -best["b"]
                tree.feature[at], tree.cut[at], tree.threshold[at], tree.gain[at] = f, cut, float(edges[f][cut]), best["gain"]
                tree.left[at] = tree.add(-eta * best["gl"] / (best["hl"] + reg), best["hl"])
                tree.right[at] = tree.add(-eta * best["gr"] / (best["hr"] + reg), best["hr"])
                open_nodes += [tree.left[at], tree.right[at]]
            if not open_nodes:
                break
        return tree


class SecondOrderModel(Model, _BoostParams, MLWritable, MLReadable):
    """Fitted trees as rows of ``NODES``, the margin before them, and the number of features."""

    def __init__(self, nodes: list[tuple] = (), base: float = 0.0, n_features: int = 0):
        super().__init__()
        self.nodes, self.base, self.n_features = list(nodes), base, n_features

    def setPredictionCol(self, value: str) -> SecondOrderModel:
        return self._set(predictionCol=value)

    def setProbabilityCol(self, value: str) -> SecondOrderModel:
        return self._set(probabilityCol=value)

    def setRawPredictionCol(self, value: str) -> SecondOrderModel:
        return self._set(rawPredictionCol=value)

    def copy(self, extra=None) -> SecondOrderModel:
        return self._copyValues(SecondOrderModel(self.nodes, self.base, self.n_features), extra)

    @property
    def featureImportances(self):
        """Mean gain of the splits of each feature, adding up to 1."""
        total, count = np.zeros(self.n_features), np.zeros(self.n_features)
        for _, _, feature, _, left, _, _, gain, _ in self.nodes:
            if left >= 0:
                total[feature] += gain
                count[feature] += 1
        mean = total / np.maximum(count, 1)
        return Vectors.dense(mean / mean.sum() if mean.sum() else mean)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        compiled = CompiledModel.of(dataset.sparkSession.createDataFrame(self.nodes, NODES), "boosted", self.base, 1.0)
        names = [self.getRawPredictionCol(), self.getProbabilityCol(), self.getPredictionCol()]
        margin = compiled.margin(vector_to_array(self.getFeaturesCol()))
        out = dataset.withColumn(names[0], margin)
        p = 1.0 / (1.0 + F.exp(-F.col(names[0])))
        out = out.withColumn(names[1], array_to_vector(F.array(1.0 - p, p)))
        out = out.withColumn(names[2], (F.col(names[0]) > 0).cast("double"))
        return out.withColumn(names[0], array_to_vector(F.array(-F.col(names[0]), F.col(names[0]))))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: SecondOrderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, {"base": m.base, "n_features": m.n_features})
        self.sparkSession.createDataFrame(m.nodes, NODES).coalesce(1).write.parquet(f"{path}/nodes")


class _ModelReader(MLReader):
    def load(self, path: str) -> SecondOrderModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        rows = self.sparkSession.read.schema(NODES).parquet(f"{path}/nodes").orderBy("tree", "node").collect()
        model = SecondOrderModel([tuple(r) for r in rows], meta["base"], meta["n_features"])
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model
