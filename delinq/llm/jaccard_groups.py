"""Exact Jaccard join of word shingles by grouped prefixes.

A document's set holds its distinct shingles of five words as 63-bit hashes. Equal sets are one class. All sets are
ordered alike: first the shingles that few documents have, then the frequent ones, each by hash. Two sets with
enough in common share a shingle among their first n - ceil(3n/4) + 1; classes with the same prefix and size are one
group, and only groups are listed under their prefix shingles.

Which shingles are frequent is counted over all documents in 2^20 counters of fixed size; the counters decide about
the order only, so any error in them costs time and never a link. Only frequent shingles can have long lists; their
lists are counted before they are joined, so none of them is gathered in one task.

Families of near copies would make all pairs of a long list. So groups of long lists, and groups of several classes, are
compared with leaders first, if enough of a group's prefix stands in long lists for near copies: a class goes to the
longest list of its group, such a cell is dealt into chunks, and a task reads a chunk once and links every member to the leaders it is similar to (at most ``LEADERS``, others are just not
compared). A chunk's main leader and those with ``FOLLOWERS`` members go on to the ``HOMES`` longest lists of their
groups, where they meet the leaders of other chunks and cells in the same way. What is linked is one component. Then only pairs of different components are left: lists that lie within one component are settled, and in
the others the members outside the list's main component meet the rest, if their sizes and places in the common order
allow it. A pair meets where its common shingles begin, not at each of them: at a shingle before which both have the
same one it has met already. The groups that are left are expanded and pass their sketches: a bit per slot says whether
an odd number of the set's shingles falls there, so two sketches differ in at most as many bits as the sets differ in
shingles, an exact bound. Then whole sets are compared. Leaders only save comparisons; every pair that might be similar
is linked by them or verified at the end.

Defined results: texts that are null or without words have an empty set and are alone; with fewer than five words
the whole sequence is the only shingle; repeated rows and equal texts are one class; rows without doc_id link like
others and never name a component that has an id; an empty table gives an empty table; a text of any length is one set,
8 bytes a distinct shingle, in one task at a time. Other columns are not read, and ``one_of_each`` returns them as they
are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delinq.llm.common import LOWER_AZ, WORD, Memory, packed, written
from delinq.llm.components import components, smallest_ids

SHINGLE = 5
SLOT_BITS = 20
_RANGE = 1024  # counters in a row
KNOWN = 200_000
#: Groups of longer lists are compared with leaders first.
LARGE = 16
#: Classes of a chunk, about, and leaders kept in it: a mask has 64 bits.
CHUNK = 1024
LEADERS = 32
#: Leaders with so many members are compared again, in so many lists.
FOLLOWERS = 4
HOMES = 4
#: Bits of a sketch, and of the second sketch of sets with as many shingles as the first has bits.
SKETCH = 1024
WIDE_SKETCH = 4096

_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORDS = Memory(KNOWN)


def shingles(texts: list[str | None], distinct: bool = True) -> list[np.ndarray]:
    """63-bit hashes of each text's shingles, sorted and distinct or as they come."""
    words = [(t or "").encode().translate(LOWER_AZ).split() for t in texts]
    new = _WORDS.missing(set().union(*words))
    known = _WORDS.now
    for word in new:
        known[word] = xxhash.xxh3_64_intdigest(word)
    out = []
    for some in words:
        if not some:
            out.append(np.empty(0, np.uint64))
            continue
        hashes = np.array([known[w] for w in some], np.uint64)
        length = min(SHINGLE, len(hashes))
        total = np.full(len(hashes) - length + 1, length, np.uint64)
        for k in range(length):
            total = (total ^ hashes[k : len(hashes) - length + 1 + k]) * _MIX
            total ^= total >> np.uint64(32)
        total >>= np.uint64(1)
        if distinct and len(total) > 1:
            total.sort()
            total = total[np.concatenate([[True], total[1:] != total[:-1]])]
        out.append(total)
    return out


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def count_slots(df: DataFrame, slots_of) -> np.ndarray:
    """Counters over all rows: slots_of(batch) gives slot numbers. 2^20 numbers reach the driver, whatever the input."""

    schema = pa.schema([("range", pa.int32()), ("counts", pa.binary())])

    def count(batches):
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in _slices(batches):
            total += np.bincount(slots_of(batch).astype(np.int64), minlength=1 << SLOT_BITS)
        for first in range(0, 1 << SLOT_BITS, 256 * _RANGE):
            rows = total[first : first + 256 * _RANGE].reshape(-1, _RANGE)
            some = np.flatnonzero(rows.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array((some + first // _RANGE).astype(np.int32)), pa.array([rows[i].astype("<i4").tobytes() for i in some], pa.binary())],
                schema=schema,
            )

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                kind = "<i4" if len(counts) == 4 * _RANGE else "<i8"
                total[i] = total.get(i, 0) + np.frombuffer(counts, kind).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v.astype("<i8").tobytes() for v in total.values()], pa.binary())],
            schema=schema,
        )

    kind = "range int, counts binary"
    found = df.mapInArrow(count, kind).repartition(32, "range").mapInArrow(add, kind).collect()
    out = np.zeros((1 << SLOT_BITS) // _RANGE * _RANGE, np.int64).reshape(-1, _RANGE)
    for row in found:
        out[row["range"]] += np.frombuffer(row["counts"], "<i8")
    return out.ravel()


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(63 - SLOT_BITS)).astype(np.int64)


def frequent_slots(docs: DataFrame) -> bytes:
    """A bit per slot: whether it holds frequent shingles."""
    counts = count_slots(
        docs.select("text"),
        lambda batch: np.concatenate([np.empty(0, np.int64), *map(_slot, shingles(batch.column(0).to_pylist(), distinct=False))]),
    )
    mean = counts.mean()
    return np.packbits(counts > mean + 4 * np.sqrt(mean) + 4).tobytes()


def _ordered(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Tokens in the common order: the highest bit marks the frequent ones."""
    slots = _slot(tokens)
    flag = (frequent[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8) & 1).astype(np.uint64)
    return np.sort(tokens | flag << np.uint64(63))


def _prefix_length(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1


def _sketch(tokens: np.ndarray, bits: int) -> np.ndarray:
    """A bit per slot: whether it holds an odd number of the tokens."""
    counts = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts.astype(np.uint8) & 1).view(np.int64)


def members(docs: DataFrame, frequent: bytes) -> DataFrame:
    """_row, doc_id, n, cls (class of equal sets), grp (class of equal prefixes and sizes), prefix, sketches; n 0 is no set."""
    schema = pa.schema(
        [("_row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("cls", pa.int64()), ("grp", pa.int64()), ("prefix", pa.binary()),
         ("sketch", pa.list_(pa.int64())), ("wide", pa.list_(pa.int64()))]
    )

    def run(batches):
        bits = np.frombuffer(frequent, np.uint8)
        for batch in _slices(batches):
            out = []
            for row, doc_id, tokens in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingles(batch.column(2).to_pylist())
            ):
                n = len(tokens)
                prefix = _ordered(tokens, bits)[: _prefix_length(n)].tobytes() if n else b""
                cls, grp = (xxhash.xxh3_64_intdigest(d, seed=n) - (1 << 63) for d in (tokens.tobytes(), prefix))
                wide = _sketch(tokens, WIDE_SKETCH) if n >= SKETCH else None
                out.append((row, doc_id, n, cls, grp, prefix, _sketch(tokens, SKETCH), wide))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    rows = docs.select(
        F.xxhash64("doc_id", "text").alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    return rows.mapInArrow(
        run, "_row long, doc_id long, n int, cls long, grp long, prefix binary, sketch array<long>, wide array<long>"
    )


def _entries(found: DataFrame) -> DataFrame:
    """token, grp, n, pos: the prefix shingles of every group, once a task."""
    schema = pa.schema([("token", pa.int64()), ("grp", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])

    def run(batches):
        seen = set()
        for batch in _slices(batches):
            parts = []
            for grp, n, prefix in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if grp not in seen:
                    seen.add(grp)
                    tokens = np.frombuffer(prefix, np.int64)
                    k = len(tokens)
                    parts.append((tokens, np.full(k, grp), np.full(k, n, np.int32), np.arange(k, dtype=np.int32)))
            if len(seen) > 1_000_000:
                seen.clear()  # groups met again are only listed twice
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], schema=schema)

    return found.where("n > 0").select("grp", "n", "prefix").mapInArrow(run, "token long, grp long, n int, pos int")


def _texts_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows (_row, ...) with their text; a fixed bitmap of their keys spares most other texts the way."""
    bits = np.packbits(
        count_slots(rows.select("_row"), lambda b: b.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - SLOT_BITS)) > 0
    ).tobytes()

    def possible(batches):
        table = np.frombuffer(bits, np.uint8)
        for batch in _slices(batches):
            slots = (batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            keep = table[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8) & 1
            yield batch.filter(pa.array(keep.astype(bool)))

    texts = docs.select(F.xxhash64("doc_id", "text").alias("_row"), "text").mapInArrow(possible, "_row long, text string")
    one = texts.dropDuplicates(["_row"])  # rows repeated as a whole
    return one.join(rows, "_row")


def _sets_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """cls, tokens of the rows (_row, cls)."""

    def run(batches):
        for batch in _slices(batches):
            sets = [t.tobytes() for t in shingles(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["cls", "tokens"])

    return _texts_of(docs, rows).select("cls", "text").mapInArrow(run, "cls long, tokens binary")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets are similar enough."""

    def run(batches):
        for batch in _slices(batches):
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep = []
            for x, y in zip(left, right):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta")), "a").join(
        sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb")), "b"
    )
    return joined.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _near_sizes(n, m):
    return 4 * F.least(n, m) >= 3 * F.greatest(n, m)


def _lists(found: DataFrame) -> DataFrame:
    """token, grp, n, pos, k: the entries of prefix shingles that several (k) groups have."""
    entries = _entries(found)
    rare = entries.where("token >= 0").repartition("token").dropDuplicates(["token", "grp"])
    rare = rare.withColumn("k", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("k > 1")
    often = written(entries.where("token < 0").dropDuplicates(["token", "grp"]), "frequent")  # the flag is the sign
    sizes = written(often.groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "sizes")
    return rare.unionByName(often.join(sizes, "token").select(rare.columns))


class _Leaders:
    """Leaders of a chunk: their shingles in one sorted array, and for each the bits of the leaders that have it."""

    def __init__(self):
        self.names: list[int] = []
        self.sets: list[np.ndarray] = []
        self.root: list[int] = []
        self.followers: list[int] = []
        self.tokens = np.empty(0, np.uint64)
        self.owners = np.empty(0, np.uint64)

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            i = self.root[i]
        return i

    def _add(self, name: int, tokens: np.ndarray) -> None:
        i = len(self.names)
        self.names.append(name)
        self.sets.append(tokens)
        self.root.append(i)
        self.followers.append(1)
        at, bit = np.searchsorted(self.tokens, tokens), np.uint64(1 << i)
        known = (at < len(self.tokens)) & (np.append(self.tokens, np.uint64(0))[at] == tokens)
        self.owners[at[known]] |= bit
        self.tokens = np.insert(self.tokens, at[~known], tokens[~known])
        self.owners = np.insert(self.owners, at[~known], bit)

    def meet(self, name: int, tokens: np.ndarray) -> list[tuple[int, int]]:
        """Links of a new member to the leaders, at most one for each set of leaders that aren't linked yet."""
        similar = []
        if self.names:
            at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
            masks = self.owners[at[self.tokens[at] == tokens]]
            sizes = np.array([len(t) for t in self.sets])
            used = masks.view(np.uint8).reshape(-1, 8)[:, : (len(sizes) + 7) // 8]
            both = np.unpackbits(used, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)[: len(sizes)]
            similar = np.flatnonzero(100 * both >= 75 * (len(tokens) + sizes - both)).tolist()
        if not similar:
            if len(self.names) < LEADERS:
                self._add(name, tokens)
            return []
        out, roots = [], set()
        for i in similar:
            if (r := self._find(i)) not in roots:
                roots.add(r)
                out.append((self.names[i], name))
        first = min(roots)
        for r in roots:
            self.root[r] = first
        self.followers[similar[0]] += 1
        return out

    def strong(self) -> list[tuple[int, bytes]]:
        """The leader with most members, and all with enough."""
        main = max(range(len(self.names)), key=lambda i: self.followers[i])
        return [(self.names[i], self.sets[i].tobytes()) for i, n in enumerate(self.followers) if i == main or n >= FOLLOWERS]


_STARS = "home long, a long, b long, tokens binary"


def _stars(batches: Iterator[pa.RecordBatch], sets_of) -> Iterator[pa.RecordBatch]:
    """Links of each cell (home, chunk) of the sorted rows (home, chunk, cls, set) and, as rows with tokens, its strong leaders."""
    cell, leaders = None, None
    for batch in _slices(batches, 64):
        out = []
        for home, chunk, cls, tokens in zip(*(batch.column(i).to_pylist() for i in range(3)), sets_of(batch.column(3))):
            if cell != (home, chunk):
                if leaders is not None:
                    out += [(cell[0], name, None, own) for name, own in leaders.strong()]
                cell, leaders = (home, chunk), _Leaders()
            out += [(home, a, b, None) for a, b in leaders.meet(cls, tokens)]
        if out:
            yield _star_batch(out)
    if leaders is not None:
        yield _star_batch([(cell[0], name, None, own) for name, own in leaders.strong()])


def _star_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("home", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("tokens", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], names=[n for n, _ in kinds])


def _leader_links(docs: DataFrame, classes: DataFrame, lists: DataFrame, several: DataFrame) -> DataFrame:
    """a, b: links of classes to leaders of their cells."""
    # The longest lists of a group: few numbers, kept sorted while they are combined. Near copies share many listed
    # shingles, so a group with fewer in long lists, as of a common passage, has no family to meet there.
    best = F.sort_array(F.collect_list(F.struct("k", "token")), asc=False)
    of_group = lists.where(F.col("k") > LARGE).groupBy("grp", "n").agg(F.slice(best, 1, HOMES)["token"].alias("homes"), F.count(F.lit(1)).alias("c"))
    longest = written(of_group.where(F.col("c") > 2 * _spare(F.col("n"), F.col("n"))).select("grp", "homes"), "homes")
    marked = classes.join(longest, "grp", "left").join(several.withColumn("many", F.lit(True)), "grp", "left")
    homes = F.coalesce("homes", F.array(F.xxhash64("grp")))
    cells = written(marked.where("homes is not null or many").select("_row", "cls", homes.alias("homes"), homes[0].alias("home")), "cells")
    sizes = written(cells.groupBy("home").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "sizes")
    chunk = F.pmod(F.xxhash64("cls"), F.ceil(F.col("k") / CHUNK)).cast("int")
    chunked = written(cells.join(sizes, "home").select("_row", "cls", "home", chunk.alias("chunk")), "chunks")
    texts = _texts_of(docs, chunked).select("home", "chunk", "cls", "text")
    cell = ["home", "chunk"]
    first = written(
        texts.repartition(*cell).sortWithinPartitions(*cell, F.xxhash64("cls"))
        .mapInArrow(lambda batches: _stars(batches, lambda column: shingles(column.to_pylist())), _STARS),
        "stars",
    )
    strong = first.where("tokens is not null").select(F.col("a").alias("cls"), "tokens").join(cells.select("cls", "homes"), "cls")
    second = strong.select(F.explode("homes").alias("home"), F.lit(0).alias("chunk"), "cls", "tokens")
    again = second.repartition("home").sortWithinPartitions("home", "cls").mapInArrow(
        lambda batches: _stars(batches, lambda column: [np.frombuffer(t, np.uint64) for t in column.to_pylist()]), _STARS
    )
    return first.unionByName(again).where("tokens is null").select("a", "b")


def _spare(n: Column, m: Column) -> Column:
    """Listed prefix shingles that sets of sizes n <= m, similar enough, have in common at least, less one.

    With the overlap ``needed`` a set can lack n - needed of its shingles in the other. So of its first
    n - needed + 1 + s shingles at least s + 1 are shared, and of two such prefixes the one that ends first in the
    common order has them in the other, too. They lie in the listed prefixes if s <= needed - ceil(3m/4).
    """
    return F.floor((_needed(n, m) - F.ceil(3 * m / 4)) / 4)


def _needed(n: Column, m: Column) -> Column:
    return F.ceil(3 * (n + m) / 7)


def _open_pairs(lists: DataFrame, groups: DataFrame) -> DataFrame:
    """xgrp, ygrp: groups that share a shingle at places that count and aren't within one component, possibly repeated.

    groups: grp, low, high (its range of components). A list's main component is the one that most of its groups lie
    in; of a pair one group at least is outside it. Sets with the overlap ``needed`` share a shingle among the first
    n - needed + 1 of both, n/7 + 1 at most of the smaller one, so lists of a passage that comes later in all its
    documents give no pairs. The first shingle in common lies there, too, and the shingles listed before it differ: a
    shingle after an equal one repeats a pair and is left out. Sizes are cut into bands, near sizes lie in the same or
    in neighbouring ones.
    """
    before = F.lag("token").over(Window.partitionBy("grp").orderBy("pos"))  # at most n/4 + 1 rows a group
    entries = lists.join(groups, "grp").withColumns({"own": F.when(F.col("low") == F.col("high"), F.col("low")), "before": before})
    entries = written(entries.select("token", "before", "grp", "n", "pos", "low", "high", "own"), "entries")
    parts = entries.groupBy("token", "own").agg(F.count(F.lit(1)).alias("c"), F.min("low").alias("low"), F.max("high").alias("high"))
    mains = parts.groupBy("token").agg(
        F.max(F.when(F.col("own").isNotNull(), F.struct("c", "own"))).alias("main"), F.min("low").alias("l"), F.max("high").alias("h")
    )
    open_lists = written(mains.where("l < h").select("token", F.col("main.own").alias("main")), "open")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.34))).cast("int")
    outside = F.coalesce(F.col("own") != F.col("main"), F.lit(True))
    still = entries.drop("low", "high").join(open_lists, "token").withColumns({"band": band, "outside": outside}).drop("main")
    still = written(still, "still")
    early = still.where(7 * F.col("pos") <= F.col("n")).withColumn("band", F.explode(F.array("band", F.col("band") + 1)))

    def met(first: DataFrame, second: DataFrame) -> DataFrame:
        x, y = (df.select("token", "band", *[F.col(c).alias(f"{s}{c}") for c in ("grp", "n", "pos", "own", "before")]) for s, df in (("x", first), ("y", second)))
        n, m = F.col("xn"), F.col("yn")
        return x.join(y, ["token", "band"]).where(
            ((n < m) | ((n == m) & (F.col("xgrp") < F.col("ygrp")))) & _near_sizes(n, m) & F.coalesce(F.col("xown") != F.col("yown"), F.lit(True))
            & (F.col("xpos") <= n - _needed(n, m)) & (F.col("ypos") <= m - _needed(n, m))
            & F.coalesce(F.col("xbefore") != F.col("ybefore"), F.lit(True))
        )

    pairs = met(early.where("outside"), still).unionByName(met(early.where("not outside"), still.where("outside")))
    return pairs.select("xgrp", "ygrp")


def _may_link(n: Column, m: Column, x: str, y: str) -> Column:
    """Whether the sketches differ in no more bits than similar sets of these sizes can differ in shingles."""

    def differing(kind: str) -> Column:
        bits = F.zip_with(f"{x}{kind}", f"{y}{kind}", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
        return F.aggregate(bits, F.lit(0), lambda total, c: total + c)

    most = n + m - 2 * _needed(n, m)
    return (differing("sketch") <= most) & F.coalesce(differing("wide") <= most, F.lit(True))


def link(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (_row, doc_id, n, cls) of all documents, and cls, comp of the linked classes."""
    found = written(members(docs, frequent_slots(docs)), "members")
    rows = found.select("_row", "doc_id", "n", "cls", "grp")
    classes = written(rows.where("n > 0").groupBy("grp", "cls", "n").agg(F.min("_row").alias("_row")), "classes")
    several = written(classes.groupBy("grp").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("grp"), "several")
    lists = written(_lists(found), "lists")
    stars = written(_leader_links(docs, classes, lists, several), "links")
    comp = written(components(stars), "components")
    state = written(classes.join(comp, "cls", "left").select("grp", "cls", "_row", F.coalesce("comp", "cls").alias("comp")), "state")
    groups = written(state.groupBy("grp").agg(F.min("comp").alias("low"), F.max("comp").alias("high")), "groups")
    inner = groups.join(several, "grp").where("low < high").select(F.col("grp").alias("xgrp"), F.col("grp").alias("ygrp"))
    near = written(_open_pairs(lists, groups).distinct().unionByName(inner), "near")
    some = near.select(F.explode(F.array("xgrp", "ygrp")).alias("grp")).distinct()
    some = written(state.join(some, "grp"), "some")
    sketched = found.select("_row", "n", "sketch", "wide").join(some, "_row").dropDuplicates(["cls"])  # repeated rows share a key
    sketched = written(sketched, "sketches")
    first, second = (
        sketched.select(F.col("cls").alias(c), *[F.col(name).alias(f"{s}{name}") for name in ("grp", "comp", "n", "sketch", "wide")])
        for s, c in (("x", "a"), ("y", "b"))
    )
    pairs = near.join(first, "xgrp").join(second, "ygrp").where((F.col("xcomp") != F.col("ycomp")) & _may_link(F.col("xn"), F.col("yn"), "x", "y"))
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    needed = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    needed = written(needed.join(state, "cls").select("_row", "cls"), "needed")
    more = written(_verified(pairs, written(_sets_of(docs, needed), "sets")), "links")
    # Stars of the components so far stand for their links.
    return rows, written(components(more.unionByName(comp.select(F.col("cls").alias("a"), F.col("comp").alias("b")))), "components")


def cluster(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    rows, comp = link(docs)
    least = written(rows.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id")), "least")
    out = rows.join(smallest_ids(least, comp), "cls", "left")
    smallest = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), smallest.alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component: the one with the smallest doc_id (then the smallest row key); columns as given.

    Documents without words are linked with nothing and stay.
    """
    rows, comp = link(docs)
    order = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("first")
    of_class = rows.where("n > 0").groupBy("cls").agg(order)
    first = of_class.join(comp, "cls", "left").groupBy(F.coalesce("comp", "cls").alias("comp")).agg(F.min("first").alias("first"))
    kept = written(first.select(F.col("first._row").alias("key")), "kept")
    given = docs.select(packed(docs).alias("given"), F.xxhash64("doc_id", "text").alias("key"), "text")
    wordless = ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    alone = given.where(wordless).select("given")
    texts = given.where(~wordless).join(kept, "key").dropDuplicates(["key"])  # a repeated row stays once
    return texts.select("given").unionByName(alone).select("given.*")
