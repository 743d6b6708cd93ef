"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a share of all words by its weight, at most ``MAX_COPIES`` times its own words; what a capped
source cannot take is shared among the others. A document of a source with ratio r = target / own words is
taken floor(r) times and once more with probability r - floor(r).

The fractions are settled by a pivotal walk: two fractional documents exchange expected words, in a random
direction with balanced odds, until one of them is integral; the other meets the next document. The expected
words of the source stay the same in every step, so only the very last document of a source is rounded (to the
nearest). Documents are walked in groups of about ``GROUP`` rows of one source, and what each group leaves
over is walked again in groups of ``FAN_IN`` until one group a source is left, so a source that holds a third
of all rows is dealt out like the rest.

All draws come from hashes of row keys, so reruns agree. The walk runs over sorted partitions as a stream and
holds one document at a time. Levels are written to the shared folder.

Defined results: null text has no words and is never taken; a null source is a source of its own, ordered
last; without any words all targets are 0; repeated rows are rounded one by one; an empty table gives an empty
table. Other columns pass through ``mix_documents``, whatever their names. Only the number of words of a text is used,
whatever its length.
"""

from __future__ import annotations

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delinq.llm.common import packed, word_count, written

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
GROUP = 1000
FAN_IN = 64
SEED = 17

_WALK = "_row long, doc_id long, size long, source_size long, target double, base int, x double, _src long, _bucket long, _settled boolean"


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def source_targets(sized: DataFrame) -> DataFrame:
    """_key, source_size, n_docs, target per source; ``sized`` has source and size.

    Sources are ordered by how soon they reach their cap. One is capped if the level it would get, with all
    sources before it capped, is not below its cap. The windows run over one row per source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (rank - 1) % len(WEIGHTS) + 1)
    weighed = totals.withColumn("_w", weight).withColumn("_cap", MAX_COPIES * F.col("source_size"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / (
        F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    )
    capped = weighed.withColumn("_capped", F.col("_cap") <= level * F.col("_w"))
    rest = F.sum("source_size").over(everything) - F.sum(F.when(F.col("_capped"), F.col("_cap")).otherwise(0)).over(everything)
    shared = F.sum(F.when(F.col("_capped"), 0).otherwise(F.col("_w"))).over(everything)
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(rest * F.col("_w") / shared)
    return capped.select(_source_key(F.col("source")).alias("_key"), "source_size", "n_docs", target.alias("target"))


def _draw(level: int, a: int, b: int) -> float:
    return xxhash.xxh64_intdigest(f"{level}|{a}|{b}", seed=SEED) / 2.0**64


def _walk(level: int, last: bool):
    """Settle one partition, sorted by group; at most one document of a group stays open unless ``last``."""

    def meet(a, b):
        """Two open (row, size, x) exchange words; one or both leave with x 0 or 1."""
        (ra, sa, xa), (rb, sb, xb) = a, b
        to_a, to_b = min((1 - xa) * sa, xb * sb), min(xa * sa, (1 - xb) * sb)
        if _draw(level, ra, rb) * (to_a + to_b) < to_b:
            full, drained = (1 - xa) * sa <= to_a, xb * sb <= to_a
            return (ra, sa, 1.0 if full else xa + to_a / sa), (rb, sb, 0.0 if drained else xb - to_a / sb)
        full, drained = (1 - xb) * sb <= to_b, xa * sa <= to_b
        return (ra, sa, 0.0 if drained else xa - to_b / sa), (rb, sb, 1.0 if full else xb + to_b / sb)

    def run(batches):
        held, group, x_held = None, None, 0.0  # the open row, its group and its fraction

        def closed(row, x, settled):
            return {**row, "x": x, "_settled": settled}

        def left():
            return [closed(held, float(x_held >= 0.5) if last else x_held, last)]

        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                key = (row["_src"], row["_bucket"])
                if key != group:
                    if held is not None:
                        out += left()
                    held, group = None, key
                if held is None:
                    held, x_held = row, row["x"]
                    continue
                (_, _, xa), (_, _, xb) = meet((held["_row"], held["size"], x_held), (row["_row"], row["size"], row["x"]))
                if xa in (0.0, 1.0):
                    out.append(closed(held, xa, True))
                    held, x_held = row, xb
                    if xb in (0.0, 1.0):
                        out.append(closed(row, xb, True))
                        held = None
                else:
                    out.append(closed(row, xb, True))
                    x_held = xa
            if out:
                yield pd.DataFrame(out, columns=list(batch.columns))
                out = []
        if held is not None:
            yield pd.DataFrame(left(), columns=list(held))

    return run


def mix(docs: DataFrame) -> DataFrame:
    """_row, doc_id, size, source_size, target, copies, taken for every row of ``docs``."""
    sized = written(
        docs.select(
            F.xxhash64("doc_id", "source", "text").alias("_row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            "source",
            word_count(F.col("text")).alias("size"),
        ),
        "sizes",
    )
    rows = sized.withColumn("_key", _source_key(F.col("source"))).join(source_targets(sized), "_key")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("_ratio", F.least(ratio, F.lit(float(MAX_COPIES)))).withColumn("base", F.floor("_ratio").cast("int"))
    fraction = F.col("_ratio") - F.col("base")
    source = F.xxhash64("_key")
    buckets = F.greatest(F.ceil(F.col("n_docs") / GROUP), F.lit(1))
    rows = rows.select(
        "_row", "doc_id", "size", "source_size", "target", "base",
        F.when(F.col("size") > 0, fraction).otherwise(0.0).alias("x"),
        source.alias("_src"),
        F.pmod(F.xxhash64(F.col("_row"), F.lit(SEED)), buckets).alias("_bucket"),
    ).withColumn("_settled", F.col("x") == 0)
    decided, pending = [rows.where("_settled")], rows.where("not _settled")
    groups = rows.agg(F.max("_bucket")).first()[0]
    level = 0
    while groups is not None:
        last = groups == 0
        walked = written(
            pending.repartition("_src", "_bucket")
            .sortWithinPartitions("_src", "_bucket", F.desc("size"), "_row")
            .mapInPandas(_walk(level, last), _WALK),
            "walk",
        )
        decided.append(walked.where("_settled"))
        pending = walked.where("not _settled").withColumn("_bucket", F.floor(F.col("_bucket") / FAN_IN))
        groups, level = None if last else groups // FAN_IN, level + 1
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    copies = F.when(F.col("size") > 0, F.col("base") + F.col("x")).otherwise(0).cast("long")
    return out.select("_row", "doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mixed corpus: each row as often as it is taken, columns as given.

    Repeated rows share one key. How many of them are taken how often is a few numbers a key; they are written with
    the number of their task, counted by key and task, and numbered within a task only.
    """
    counts = mix(docs).groupBy("_row", "copies").agg(F.count(F.lit(1)).alias("times"))
    keys = written(
        counts.groupBy("_row").agg(
            F.sum("times").alias("_times"),
            F.sort_array(F.collect_list(F.struct("copies", "times"))).alias("_counts"),  # at most MAX_COPIES + 1
        ),
        "copies",
    )
    rows = docs.select(packed(docs).alias("given"), F.xxhash64("doc_id", "source", "text").alias("_row"))
    single = keys.where("_times = 1").select("_row", F.col("_counts")[0]["copies"].alias("_n")).where("_n > 0")
    # Texts are merged with their counts at any size: small counts would be broadcast, and then no longer.
    out = rows.join(single.hint("merge"), "_row").select("given", "_n")
    repeated = keys.where("_times > 1").select("_row", "_counts")
    if not repeated.isEmpty():
        dealt = written(rows.join(repeated, "_row").withColumn("_part", F.spark_partition_id()), "repeated")
        sizes = dealt.groupBy("_row", "_part").agg(F.count(F.lit(1)).alias("_size"))
        before = Window.partitionBy("_row").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select("_row", "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
        nth = F.row_number().over(Window.partitionBy("_row", "_part").orderBy("_row"))
        numbered = dealt.withColumn("_nth", nth).join(starts, ["_row", "_part"])
        found = F.aggregate(
            "_counts",
            F.struct((F.col("_start") + F.col("_nth")).alias("left"), F.lit(0).cast("long").alias("n")),
            lambda at, c: F.struct(
                (at["left"] - c["times"]).alias("left"),
                F.when((at["left"] > 0) & (at["left"] <= c["times"]), c["copies"]).otherwise(at["n"]).alias("n"),
            ),
            lambda at: at["n"],
        )
        out = out.unionByName(numbered.withColumn("_n", found).where("_n > 0").select("given", "_n"))
    return out.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).select("given.*")
