"""Exact nearest neighbours by a metric partition with pivots.

Pivots are far points of a bounded sample. Every point goes to the cell of its nearest pivot, and a cell is split into
blocks of bounded size. The neighbours inside its own block tell a point how far better ones can be. For each cell the
range of distances to every pivot is known (P * P pairs of numbers); by the triangle inequality a point at distance d from a
pivot is at least as far from any point of a cell as d is from that range. Only cells that no pivot rules out are visited.

Points are written once, in regions of many blocks, to the shared folder. A task holds some queries and opens the regions
they need one after the other, nearest first, so neither points nor queries travel or are written once for each pair of
regions: shuffled and written rows are as many as points, whatever the number of distances.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delinq.functions.numeric import uniform
from delinq.session import materialise, scratch_path

# The grouped functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Points that pivots are chosen from, about; pivots at most.
SAMPLE = 2000
MAX_PIVOTS = 256
#: Blocks are kept in one file up to about this many points.
REGION_ROWS = 20000
#: Queries of a task: fewer than ``QUERY_ROWS`` if that makes fewer than ``MIN_TASKS`` tasks, but not below ``MIN_QUERY_ROWS``.
QUERY_ROWS = 5000
MIN_QUERY_ROWS = 500
MIN_TASKS = 32

_PAIRS = "array<struct<dist:double,other:string>>"


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0.0))


class _Targets:
    """Points that queries are compared with: a bound by 32-bit products rules out most, the others are measured exactly."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        self.x, self.ids = x, ids
        norms = (x**2).sum(1)
        # Where 32 bits could overflow, 64 are used.
        self.kind = np.float32 if len(x) and norms.max() < 1e30 else np.float64
        # Rounding of products and sums of x.shape[1] numbers, with a margin of 4.
        self.error = (x.shape[1] + 8) * float(np.finfo(self.kind).eps) * 2
        self.short, self.norms = x.astype(self.kind), norms

    def near(self, a: np.ndarray, own_ids: np.ndarray, reach: np.ndarray, k: int) -> list[list[tuple[float, str]]]:
        """For each query the k nearest (by distance, then id) of the targets no farther than ``reach``, itself excluded."""
        short, norms = self.short, self.norms
        kind = self.kind if len(a) and (a**2).sum(1).max() < 1e30 else np.float64
        out: list[list[tuple[float, str]]] = [[] for _ in range(len(a))]
        step = max(1, 2_000_000 // max(1, len(norms)))
        for start in range(0, len(a), step):
            part, most = a[start : start + step], reach[start : start + step]
            # |a - b|^2 <= r^2 is |b|^2 / 2 - a.b <= (r^2 - |a|^2) / 2; what rounding may add goes to both sides.
            own = (part**2).sum(1)
            product = part.astype(kind) @ short.T
            product -= (norms * (1 - self.error) / 2).astype(kind)
            least = (own * (1 - self.error) - most**2 * (1 + 1e-9)) / 2
            least -= (np.abs(least) + own) * self.error
            rows, found = np.nonzero(~(product < least.astype(kind)[:, None]))
            for row, first, last in zip(*_runs(rows)):
                some = found[first:last]
                dist = np.sqrt(((self.x[some] - part[row]) ** 2).sum(1))
                pairs = [(float(d), str(self.ids[j])) for d, j in zip(*_least(dist, some, k)) if self.ids[j] != own_ids[start + row]]
                out[start + row] = sorted(p for p in pairs if not p[0] > most[row])[:k]
        return out


def _runs(sorted_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each number with its first and its end place."""
    number, first = np.unique(sorted_rows, return_index=True)
    return number, first, np.append(first[1:], len(sorted_rows))


def _least(dist: np.ndarray, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """What can be among the k nearest without one point itself: nothing beyond the distance of number k + 1."""
    if len(dist) <= k + 1:
        return dist, places
    keep = ~(dist > np.partition(dist, k)[k])
    return dist[keep], places[keep]


#: Targets that give a query its first bound.
FIRST = 2000


def _nearest(queries: pd.DataFrame, others: pd.DataFrame, k: int) -> list[list[tuple[float, str]]]:
    """The k nearest of ``others`` for each query, the query itself excluded; ties by id."""
    if others.empty:
        return [[] for _ in range(len(queries))]
    targets = _Targets(np.stack(others["x"].to_numpy()), others["id"].to_numpy())
    return _nearest_of(np.stack(queries["x"].to_numpy()), queries["id"].to_numpy(), targets, k)


def _nearest_of(a: np.ndarray, own_ids: np.ndarray, targets: _Targets, k: int) -> list[list[tuple[float, str]]]:
    reach = np.full(len(a), np.inf)
    if len(targets.x) > 2 * FIRST:
        first, step = targets.x[:FIRST], 1000
        for start in range(0, len(a), step):
            part = a[start : start + step]
            # One more than k: the query may be among them. Rounding must not make the bound too small.
            far = np.partition(_distances(part, first), k, axis=1)[:, k]
            reach[start : start + step] = far * (1 + 1e-9) + 1e-6 * np.sqrt((part**2).sum(1) + targets.norms[:FIRST].max())
    return targets.near(a, own_ids, reach, k)


class _Region:
    """The points of a region's files, in the order of their blocks."""

    def __init__(self, folder: str, number: int):
        if folder.startswith("file:"):
            files, path = fs.LocalFileSystem(), folder.removeprefix("file:")
        else:
            files, path = fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
        table = pq.read_table(f"{path}/region={number}", filesystem=files, partitioning=None, use_threads=False).combine_chunks()
        block = table["block"].to_numpy()
        order = np.argsort(block, kind="stable")
        self.block, self.ids = block[order], table["id"].to_numpy()[order]
        self.asks = table["asks"].to_numpy()[order]
        x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.x = x.reshape(len(block), -1)[order]
        self.runs = {int(b): slice(first, last) for b, first, last in zip(*_runs(self.block))}

    def targets(self, block: int) -> _Targets:
        return _Targets(self.x[self.runs[block]], self.ids[self.runs[block]])


def _as_found(pairs: list[tuple[float, str]]) -> list[dict[str, object]]:
    return [{"dist": d, "other": o} for d, o in pairs]


def choose_pivots(points: DataFrame, n: int, wanted: int, seed: int) -> np.ndarray:
    """Up to ``wanted`` different points, each the farthest from those before it, of a sample by hash."""
    some = points if n <= SAMPLE else points.where(uniform(F.col("id"), seed) < SAMPLE / n)
    rows = some.select("id", "x").collect() or points.select("id", "x").limit(1).collect()
    x = np.array([r["x"] for r in sorted(rows, key=lambda r: r["id"])])
    chosen = [0]
    gap = _distances(x, x[:1])[:, 0]
    while len(chosen) < wanted and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, _distances(x, x[chosen[-1:]])[:, 0])
        gap[chosen] = 0.0
    return x[chosen]


def _shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder with its scheme, as Spark's file system resolves it, for tasks that open files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, name))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def nearest_neighbours(
    points: DataFrame, k: int = 5, block_rows: int = 20000, seed: int = 42, stats: dict | None = None, asking: str | None = None
) -> DataFrame:
    """Exact k nearest neighbours of points (id, x array<double>): id, found (by distance, then id).

    ``asking`` names a boolean column of the points that want their neighbours, all without it; all points may be neighbours.
    A cell with more than about ``block_rows`` points, such as one with many equal points, has several blocks. The blocks
    of neighbouring numbers make a region of about ``REGION_ROWS`` points, or one block if that is larger. No task holds more
    than ``QUERY_ROWS`` queries and two regions, and it returns k pairs per query. ``stats`` gets the number of distances
    that were computed ("pairs") of all there are ("all"), and of visits of a query to a region beyond its own block ("visits").

    Far fewer cells are visited where points lie in clusters; where all distances are alike the bounds rule out little
    and the time grows with the product of queries and points. What is shuffled and written grows with the points.
    """
    spark = points.sparkSession
    n = points.count()
    if not n:
        return points.select("id").withColumn("found", F.array().cast(_PAIRS))
    pivots = choose_pivots(points, n, min(MAX_PIVOTS, math.ceil(4 * n / block_rows)), seed)

    def place(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(cell=_distances(np.stack(pdf["x"].to_numpy()), pivots).argmin(1).astype(np.int32))

    asks = F.lit(True) if asking is None else F.coalesce(F.col(asking), F.lit(False))
    asked = points.select("id", "x", asks.alias("asks"))
    placed = materialise(asked.mapInPandas(place, "id string, x array<double>, asks boolean, cell int"), "points")

    def spread(batches):
        low, high = np.full((len(pivots),) * 2, np.inf), np.full((len(pivots),) * 2, -np.inf)
        for pdf in batches:
            if len(pdf):
                d = _distances(np.stack(pdf["x"].to_numpy()), pivots)
                np.minimum.at(low, pdf["cell"].to_numpy(), d)
                np.maximum.at(high, pdf["cell"].to_numpy(), d)
        cell, pivot = np.nonzero(low <= high)
        yield pd.DataFrame({"cell": cell, "pivot": pivot, "low": low[cell, pivot], "high": high[cell, pivot]})

    found_ranges = placed.select("x", "cell").mapInPandas(spread, "cell int, pivot int, low double, high double")
    low, high = np.full((len(pivots),) * 2, np.inf), np.full((len(pivots),) * 2, -np.inf)
    for r in found_ranges.groupBy("cell", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        low[r["cell"], r["pivot"]], high[r["cell"], r["pivot"]] = r["low"], r["high"]
    n_parts = F.ceil(F.count(F.lit(1)) / block_rows).cast("int")
    parts = np.zeros(len(pivots), np.int64)
    for r in placed.groupBy("cell").agg(n_parts.alias("parts")).collect():  # a row a pivot
        parts[r["cell"]] = r["parts"]
    first = np.cumsum(parts) - parts
    cell_of = np.repeat(np.arange(len(pivots)), parts)
    per_region = max(1, REGION_ROWS // block_rows)
    regions = math.ceil(len(cell_of) / per_region)
    starts, held = (F.array(*[F.lit(int(v)) for v in values])[F.col("cell")] for values in (first, parts))
    block = (starts + F.pmod(F.xxhash64("id"), held.cast("long"))).cast("int")
    blocks = placed.select("id", "x", "asks", block.alias("block")).withColumn("region", F.floor(F.col("block") / per_region).cast("int"))
    folder = _shared_folder(spark, "regions")
    blocks.repartition(regions, "region").write.partitionBy("region").parquet(folder)
    kept = spark.read.schema(blocks.schema).parquet(folder)
    sizes = {r["region"]: r["asks"] for r in kept.groupBy("region").agg(F.count_if("asks").alias("asks")).collect()}  # a row a region
    step = min(QUERY_ROWS, max(MIN_QUERY_ROWS, math.ceil(sum(sizes.values()) / MIN_TASKS)))
    tasks = [(g, start, start + step) for g, rows in sorted(sizes.items()) for start in range(0, rows, step)]

    def answers(own_number: int, start: int, stop: int) -> pd.DataFrame:
        own = _Region(folder, own_number)
        rows = np.flatnonzero(own.asks)[start:stop]
        x, ids, own_block = own.x[rows], own.ids[rows], own.block[rows]
        found: list[list[tuple[float, str]]] = [[] for _ in rows]
        compared, visits = np.full(len(rows), len(pivots)), np.zeros(len(rows), np.int64)
        for number, a, b in zip(*_runs(own_block)):
            targets = own.targets(int(number))
            found[a:b] = _nearest_of(x[a:b], ids[a:b], targets, k)
            compared[a:b] += len(targets.x)
        reach = np.array([f[-1][0] if len(f) >= k else np.inf for f in found])
        d = _distances(x, pivots)
        bound = np.zeros((len(rows), len(pivots)))
        for p in range(len(pivots)):  # how far each cell is at least, by each pivot
            np.maximum(bound, np.maximum(d[:, p : p + 1] - high[:, p], low[:, p] - d[:, p : p + 1]), out=bound)
        # Rounding must not hide a neighbour; nothing is nearer than k at distance 0.
        scale = d.max(1) * 1e-7 + 1e-9
        looking = reach > 0

        def open_to(cell: int) -> np.ndarray:
            return looking & (bound[:, cell] <= reach * (1 + 1e-9) + scale)

        # What lies near shortens the reach, so that less of what lies far is opened.
        middle = bound.mean(0)
        for number in sorted(sizes, key=lambda g: (g != own_number, middle[cell_of[g * per_region : (g + 1) * per_region]].min())):
            numbers = range(number * per_region, min((number + 1) * per_region, len(cell_of)))
            if not any(open_to(cell).any() for cell in {int(cell_of[b]) for b in numbers}):
                continue
            region = own if number == own_number else _Region(folder, number)
            seen = np.zeros(len(rows), bool)
            for b in sorted(region.runs, key=lambda b: middle[cell_of[b]]):
                some = np.flatnonzero(open_to(cell_of[b]) & (own_block != b))
                if not len(some):
                    continue
                targets = region.targets(b)
                seen[some] = True
                compared[some] += len(targets.x)
                for row, pairs in zip(some.tolist(), targets.near(x[some], ids[some], reach[some], k)):
                    if pairs:
                        found[row] = sorted(found[row] + pairs)[:k]
                        if len(found[row]) == k:
                            reach[row] = min(reach[row], found[row][-1][0])
            visits += seen
        return pd.DataFrame({"id": ids, "found": [_as_found(f) for f in found], "compared": compared, "visits": visits})

    def search(batches):
        for pdf in batches:
            for number in pdf["id"]:
                yield answers(*tasks[number])

    # One task for each piece of queries; what they read lies in the shared folder.
    pieces = spark.range(0, len(tasks), 1, max(1, len(tasks)))
    answered = materialise(pieces.mapInPandas(search, f"id string, found {_PAIRS}, compared long, visits long"), "neighbours")
    if stats is not None:
        pairs, visits = answered.agg(F.sum("compared"), F.sum("visits")).first()
        stats.update(pairs=pairs or 0, visits=visits or 0, all=n * sum(sizes.values()))
    # A repeated id has the nearest of all its points.
    return answered.groupBy("id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("found"))
