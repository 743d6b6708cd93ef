"""Exact order statistics without a global sort in one task.

All functions cut the value range into slices first, so that every ordered window runs inside
one slice; slice totals (a row a slice) carry the counts over.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delinq.session import materialise

SLICES = 256
#: Rows of a slice at most, about; beyond ``SLICES`` such slices the values are dealt out by range.
SLICE_ROWS = 1_000_000


def _sliced(df: DataFrame, grouped: DataFrame, value: str, slice_rows: int) -> DataFrame:
    """The grouped values with their ``_slice``; slices hold about ``slice_rows`` rows of ``df`` or fewer.

    One pass over the rows counts them and takes approximate quantiles, which only balance the slices: a slice holds at
    most about 1/``SLICES`` of the rows beside one frequent value, and a value is one row once the rows are grouped.
    Where that is too much, Spark deals the groups into as many ranges as the rows need.
    """
    steps = [i / SLICES for i in range(1, SLICES)]
    n, found = df.agg(F.count(value), F.percentile_approx(F.col(value), steps, F.lit(10000))).first()
    if n <= SLICES * slice_rows:
        bounds = F.array(*[F.lit(b) for b in sorted(set(found or []))]).cast(f"array<{df.schema[value].dataType.simpleString()}>")
        # The coalesce makes the slice non-nullable: otherwise the join of the offsets would push a null test
        # of the slice, and with it the bound search, down to the raw rows.
        return grouped.withColumn("_slice", F.coalesce(F.size(F.filter(bounds, lambda b: b < F.col(value))), F.lit(0)))
    ranges = grouped.repartitionByRange(math.ceil(n / slice_rows), value)
    return materialise(ranges.withColumn("_slice", F.spark_partition_id()), "ranges")  # the numbers must stay


def cumulative_counts(
    df: DataFrame, value: str, counts: dict[str, Column], slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Per distinct value: the counts, and for each ``<name>_below`` = sum over smaller values.

    ``counts`` maps output names to aggregate expressions that add up (``sum``, ``count``). Sums run inside slices of
    bounded size; a second, small scan over the slice totals gives the offsets.
    """
    names = list(counts)
    grouped = df.groupBy(value).agg(*[expr.alias(name) for name, expr in counts.items()])
    sliced = _sliced(df, grouped, value, slice_rows)
    # A row a slice: a few hundred, or one for a million rows.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(*[F.sum(n).alias(n) for n in names])
        .select("_slice", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}_offset") for n in names])
    )
    inside = Window.partitionBy("_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    running = sliced.withColumns({f"_{n}_inside": F.coalesce(F.sum(n).over(inside), F.lit(0)) for n in names})
    joined = running.join(offsets, "_slice")
    return joined.select(
        value,
        *names,
        *[(F.col(f"_{n}_offset") + F.col(f"_{n}_inside")).alias(f"{n}_below") for n in names],
    )


def order_key(key: Column, seed: int) -> Column:
    """Hash text that orders rows at random, the same on every engine and partitioning."""
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def pick_exactly(
    df: DataFrame, key: str, label: str, take: Column, seed: int, output: str = "picked"
) -> DataFrame:
    """Flag an exact number of rows of each class of a 0/1 label, by hash order of a unique key.

    ``take`` gives the number to pick as an expression over ``_n``, the size of the class. The
    result is a cut-off hash per class, so rows are only scanned, never sorted or shuffled as a
    whole: rows are counted by hash prefix (4096 per class), and only the one prefix in which
    the limit falls is ranked.
    """
    order = order_key(F.col(key), seed)
    keyed = df.filter(F.col(label).isin(0, 1)).select(label, order.alias("_order"))
    keyed = keyed.withColumn("_prefix", F.substring("_order", 1, 3))
    counts = keyed.groupBy(label, "_prefix").agg(F.count(F.lit(1)).alias("_rows"))
    classes = Window.partitionBy(label)
    before = classes.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    left = (
        counts.withColumns(
            {"_n": F.sum("_rows").over(classes), "_before": F.coalesce(F.sum("_rows").over(before), F.lit(0))}
        )
        .withColumn("_left", take - F.col("_before"))
        .select(label, "_prefix", "_rows", "_left")
    )
    # Both small sides below have at most one row per class, two in all.
    split_prefix = left.filter((F.col("_left") > 0) & (F.col("_left") < F.col("_rows")))
    ranked = keyed.join(F.broadcast(split_prefix), [label, "_prefix"]).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(label).orderBy("_order"))
    )
    inner_cut = ranked.filter(F.col("_rank") == F.col("_left")).select(label, F.col("_order").alias("_cut"))
    # "g" sorts after every hexadecimal digit: a cut-off behind a whole prefix.
    whole_cut = (
        left.filter(F.col("_left") >= F.col("_rows"))
        .groupBy(label)
        .agg(F.concat(F.max("_prefix"), F.lit("g")).alias("_cut"))
    )
    cuts = inner_cut.unionByName(whole_cut).groupBy(label).agg(F.max("_cut").alias("_cut"))
    joined = df.join(F.broadcast(cuts), label, "left")
    return joined.withColumn(output, F.coalesce(order <= F.col("_cut"), F.lit(False))).drop("_cut")


def exact_medians(df: DataFrame, columns: list[str], accuracy: int = 10000) -> dict[str, float | None]:
    """Exact median per numeric column (mean of the middle two); only these scalars are fetched.

    A sketch brackets every median first. The second pass counts the values below each bracket
    and sorts only the distinct values inside it, a few ten-thousandths of the rows. Should a
    bracket miss its middle ranks, the whole range of that column is searched.
    """
    margin = 2.0 / accuracy
    sketch = df.agg(
        *[
            F.percentile_approx(F.col(c).cast("double"), [0.5 - margin, 0.5 + margin], F.lit(accuracy)).alias(c)
            for c in columns
        ]
    ).first()
    medians: dict[str, float | None] = {c: None for c in columns}
    brackets = {c: (sketch[c][0], sketch[c][1]) for c in columns if sketch[c] is not None}
    found = _search_brackets(df, brackets)
    missed = {c: (float("-inf"), float("inf")) for c in brackets if c not in found}
    return {**medians, **found, **_search_brackets(df, missed)}


def _search_brackets(df: DataFrame, brackets: dict[str, tuple[float, float]]) -> dict[str, float]:
    if not brackets:
        return {}
    x = {name: F.col(name).cast("double") for name in brackets}
    sizes = df.agg(*[F.struct(F.count(x[n]).alias("n"), F.count_if(x[n] < low).alias("below")).alias(n) for n, (low, _) in brackets.items()]).first()
    # Only values inside their bracket are unfolded; the others are counted where they are.
    cells = [F.struct(F.lit(n).alias("column"), F.when(x[n].between(low, high), x[n]).alias("value")) for n, (low, high) in brackets.items()]
    inside = df.select(F.inline(F.filter(F.array(*cells), lambda cell: cell["value"].isNotNull())))
    counts = inside.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    facts = df.sparkSession.createDataFrame([(n, *sizes[n]) for n in brackets], "column string, total long, below long")
    c = F.col
    upto = Window.partitionBy("column").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.join(F.broadcast(facts), "column").withColumn("upto", c("below") + F.sum("rows").over(upto))
    covers = lambda rank: (c("upto") - c("rows") < rank) & (rank <= c("upto"))
    middle = ranked.groupBy("column").agg(
        F.max(F.when(covers(F.floor((c("total") + 1) / 2)), c("value"))).alias("lower"),
        F.max(F.when(covers(F.floor((c("total") + 2) / 2)), c("value"))).alias("upper"),
    )
    return {
        r["column"]: (r["lower"] + r["upper"]) / 2
        for r in middle.filter(c("lower").isNotNull() & c("upper").isNotNull()).collect()
    }
