"""Interaction of filters, audited by counting paths through the lattice of filter subsets.

A state of the lattice is the set of filters already applied, an edge applies one more. Orders of all filters are the
paths from the empty to the full set. A forward pass counts the paths that reach each state, a backward pass those that
leave it; their product over an edge is the number of orders that use it. What an edge removes is counted once, from the
numbers of documents by the set of filters they fail. The steps of every order are then the edges on its path, and a
filter's Shapley sum is what its edges remove, weighted by the orders through them.

Documents are reduced to one small row before any shuffle; copies of a text meet only as counts, so a third of all rows
with one text, one source or one doc_id costs a few rows a task. Only fixed tables of the lattice (at most 2^k states
and k! orders for k filters) are broadcast.

Defined results: a null text is the empty text, a null source the empty string; rows repeated with one doc_id are all
counted and none of them is a smaller copy of another; rows without doc_id have no labels, never fail E and are no
one's smaller copy; of several labels of a doc_id each flag holds if one of them sets it, null flags set nothing; an
empty table gives no rows. Texts of any length are read whole, one row at a time. Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delinq.llm.common import let, words_of, written

#: The filters and their limits.
FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT = 65
MAX_CAPITALS = 5
SYMBOLS = "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text without null fails."""
    words = words_of(text)
    few = let(words, lambda w: (F.size(w) < MIN_WORDS).cast("int") + 2 * (100 * F.size(F.array_distinct(w)) < MIN_DISTINCT * F.size(w)).cast("int"))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    loud = 100 * capitals.cast("long") > MAX_CAPITALS * F.length(text).cast("long")
    return few + 4 * loud.cast("int") + 8 * text.rlike(SYMBOLS).cast("int")


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (bits of the filters failed), n, good, toxic: numbers of documents by what they fail.

    The last filter, E, fails on copies of a text with a smaller doc_id. Its copies are counted by text first, and the
    one smallest doc_id of a text is taken off that count.
    """
    clean = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    facts = clean.select("doc_id", "part", text_failures(F.col("text")).alias("mask"), F.unhex(F.sha2("text", 256)).alias("same"))
    rows = facts.groupBy("doc_id", "part", "mask", "same").agg(F.count(F.lit(1)).alias("n"))
    flags = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    )
    named = rows.where("doc_id is not null").join(flags, "doc_id", "left").fillna(0, ["good", "toxic"])
    unnamed = rows.where("doc_id is null").select("doc_id", "part", "mask", "same", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    groups = named.select(unnamed.columns).unionByName(unnamed).groupBy("same", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("free"),
    )
    groups = written(groups, "copies")
    least = groups.groupBy("same").agg(F.min("first.doc_id").alias("least"))
    own = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0) + F.col("free")
    split = groups.join(least, "same").select(
        "part", "good", "toxic",
        F.explode(F.array(F.struct("mask", own.alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - own).alias("n")))).alias("c"),
    )
    return split.where("c.n > 0").groupBy("part", "c.mask").agg(
        F.sum("c.n").alias("n"), F.sum(F.col("c.n") * F.col("good")).alias("good"), F.sum(F.col("c.n") * F.col("toxic")).alias("toxic")
    )


def path_counts(k: int) -> tuple[list[int], list[int]]:
    """For each state (bits of k filters): the paths that reach it from the empty set, and that leave it to the full one."""
    bits = [1 << i for i in range(k)]
    reach, leave = [0] * (1 << k), [0] * (1 << k)
    reach[0] = leave[-1] = 1
    for state in range(1, 1 << k):
        reach[state] = sum(reach[state ^ b] for b in bits if state & b)
    for state in range((1 << k) - 2, -1, -1):
        leave[state] = sum(leave[state | b] for b in bits if not state & b)
    return reach, leave


def edge_counts(cells: DataFrame, k: int) -> DataFrame:
    """part, state, bit, orders, and the counts of every edge of the lattice; zeros included.

    cells: part, mask, n, good, toxic as from ``failures``. Every part has at most 2^k of them.
    """
    reach, leave = path_counts(k)
    edges = [
        F.struct(F.lit(state).alias("state"), F.lit(1 << i).alias("bit"), F.lit(reach[state] * leave[state | 1 << i]).cast("long").alias("orders"))
        for state in range(1 << k) for i in range(k) if not state >> i & 1
    ]
    each = cells.withColumn("e", F.explode(F.array(*edges))).select("*", "e.*")
    mask, state, bit = F.col("mask"), F.col("state"), F.col("bit")
    alive, hit = mask.bitwiseAND(state) == 0, mask.bitwiseAND(bit) != 0

    def total(test: Column, of: str = "n") -> Column:
        return F.sum(F.when(test, F.col(of)).otherwise(0)).cast("long")

    return each.groupBy("part", "state", "bit", "orders").agg(
        total(alive & ~hit).alias("kept"),
        total(alive & hit).alias("removed"),
        total(~alive & hit).alias("redundant"),
        total(mask == bit).alias("unique_fails"),
        total(alive & hit, "good").alias("good_lost"),
        total(alive & hit, "toxic").alias("toxic_lost"),
    )


def audit(cells: DataFrame, letters: str = FILTERS) -> DataFrame:
    """part, filter_order, step and the counts of that step, for every part and every order of the filters."""
    edges = edge_counts(cells, len(letters))
    own = Window.partitionBy("part", "bit")
    edges = edges.withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(own).cast("long"))
    steps = []
    for order in permutations(letters):
        state = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << letters.index(letter)
            steps.append(("".join(order), step, state, bit))
            state |= bit
    paths = cells.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, bit int")
    return edges.join(F.broadcast(paths), ["state", "bit"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
