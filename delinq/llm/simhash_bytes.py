"""SimHash near duplicates by an inverted index of byte positions with count filtering.

A fingerprint has 64 bits: a bit is 1 where more than half of the hashes of a text's shingles (three words, repeats
included) have it. Two fingerprints link at ``BITS`` (2) or fewer differing bits. Each differing bit spoils one byte,
so linked fingerprints share at least 6 of their 8 positional bytes, and of the four pairs of neighbouring positions at
least two are wholly shared. The index therefore lists every distinct fingerprint under its six choices of two position
pairs, each with their four bytes; a pair that shares enough meets in at least one list. In a list the shared positional
bytes of its members are tallied, pairs with at least six are retained and verified bit by bit.

Lists of more than ``LIST`` members are listed anew under two more of the other four positions, which linked members
must share too. Such a list fixes six bytes, so every pair in it has reached the minimum and it has at most 2^16 members,
whatever the input: its members are verified by looking up the 136 values within two bits of each of the remaining
16 bits, without forming pairs. Each list gives at most one link a member, to the least one it reaches.

Documents with one fingerprint are one class before anything is listed, and classes, not documents, are linked. Sizes of
lists come from counts that are combined before the shuffle; no list is ever gathered beyond 2^16 numbers.

Defined results: null texts and texts without words have fingerprint zero and link like others; with fewer than three
words the whole sequence is the only shingle; a component is named by its smallest doc_id, rows without doc_id link but
never name one (null if no member has an id); repeated rows are repeated in the result; an empty table gives no rows.
Texts are read whole, in slices of ``HASHES`` shingles. Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delinq.llm.common import LOWER_AZ, written
from delinq.llm.components import components, smallest_ids

#: Words of a shingle, seed of its hash, bits that linked fingerprints may differ in.
SHINGLE = 3
SEED = 42
BITS = 2
#: Shingles hashed at a time.
HASHES = 1 << 16
#: Longer lists are listed anew under two more bytes.
LIST = 128

#: Positional bytes that linked fingerprints share at least.
SHARED = 8 - BITS
_FLIPS = np.array([sum(1 << b for b in some) for k in range(1, BITS + 1) for some in combinations(range(16), k)], np.uint16)


def fingerprint(text: bytes) -> int:
    """The fingerprint of a text in UTF-8, unsigned."""
    words = text.translate(LOWER_AZ).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(SHINGLE, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    total, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), HASHES):
        some = [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + HASHES], ends[at : at + HASHES])]
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, cls (the fingerprint as a signed number) of every row."""

    def run(batches):
        for batch in batches:
            found = (fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.fromiter(found, np.uint64, batch.num_rows).view(np.int64))], names=["doc_id", "cls"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, cls long")


def _choices(positions: tuple[tuple[int, ...], ...], own: str = "cls") -> F.Column:
    """Structs (kept, part) for every choice of positions: its number among ``_SETS`` and the bytes there."""
    masks = [sum(0xFF << 8 * p for p in some) for some in positions]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.array(*[F.struct(F.lit(_SETS[some]).alias("kept"), F.col(own).bitwiseAND(m).alias("part")) for some, m in zip(positions, signed)])


_PAIRS = [(2 * k, 2 * k + 1) for k in range(4)]
#: Choices of four positions (two position pairs), and for each of them the choices with two more positions.
_FOUR = [a + b for a, b in combinations(_PAIRS, 2)]
_SIX = {four: [tuple(sorted(four + two)) for two in combinations([p for p in range(8) if p not in four], 2)] for four in _FOUR}
_SETS = {some: i for i, some in enumerate(sorted({*_FOUR, *(s for six in _SIX.values() for s in six)}))}
_AT = {i: some for some, i in _SETS.items()}


def lists(classes: DataFrame) -> DataFrame:
    """kept, part, members: the lists of the index with several distinct fingerprints; at most 2^16 of them."""
    postings = classes.select("cls", F.explode(_choices(_FOUR)).alias("e")).select("e.*", "cls")
    sizes = written(postings.groupBy("kept", "part").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "sizes")
    several = postings.join(sizes, ["kept", "part"])
    finer = F.coalesce(*[F.when(F.col("kept") == _SETS[four], _choices(_SIX[four])) for four in _FOUR])
    again = F.when(F.col("k") > LIST, finer).otherwise(F.array(F.struct("kept", "part")))
    # Two coarse lists may name the same finer one; its members are the same then.
    placed = several.select("cls", F.explode(again).alias("e")).select("e.*", "cls").distinct()
    return placed.groupBy("kept", "part").agg(F.collect_list("cls").alias("members")).where("size(members) > 1")


def _roots_of_few(members: np.ndarray) -> np.ndarray:
    """For each member the least index it reaches, after tally and verification of the pairs of a short list."""
    differ = members[:, None] ^ members[None, :]
    shared = (differ.view(np.uint8).reshape(*differ.shape, 8) == 0).sum(axis=2)
    linked = (shared >= SHARED) & (np.bitwise_count(differ) <= BITS)
    root = np.arange(len(members))
    while True:
        new = np.where(linked, root[None, :], len(members)).min(axis=1)
        if (new == root).all():
            return root
        root = new[new]


def _roots_of_many(rest: np.ndarray) -> np.ndarray:
    """The same for members that share six bytes, by the 16 bits that are left of each."""
    place = np.full(1 << 16, -1, np.int64)
    place[rest] = np.arange(len(rest))
    root = np.arange(len(rest))
    while True:
        new = root.copy()
        for flip in _FLIPS:
            other = place[rest ^ flip]
            there = other >= 0
            new[there] = np.minimum(new[there], root[other[there]])
        if (new == root).all():
            return root
        root = new[new]


def list_links(members: np.ndarray, kept: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) of a list whose members share the bytes at the positions ``kept``, one a member at most."""
    members = np.sort(members.view(np.uint64))
    if len(members) <= LIST:
        root = _roots_of_few(members)
    else:
        free = [p for p in range(8) if p not in kept]
        low, high = (members >> np.uint64(8 * p) & np.uint64(255) for p in free)
        root = _roots_of_many((low | high << np.uint64(8)).astype(np.uint16))
    moved = root != np.arange(len(members))
    return members[moved].view(np.int64), members[root[moved]].view(np.int64)


def links(classes: DataFrame) -> DataFrame:
    """a, b: verified links that join the distinct fingerprints (cls) as all pairs within ``BITS`` would."""

    def run(batches):
        for batch in batches:
            found = [
                list_links(np.array(members, np.int64), _AT[kept])
                for kept, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            ]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(side)) for side in zip(*found)], names=["a", "b"])

    return lists(classes).select("kept", "members").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    prints = written(fingerprints(docs), "prints")
    classes = written(prints.groupBy("cls").agg(F.min("doc_id").alias("doc_id")), "classes")
    named = smallest_ids(classes, components(links(classes.select("cls"))))
    return prints.join(named, "cls").select("doc_id", F.lower(F.lpad(F.hex("cls"), 16, "0")).alias("fingerprint"), "component_id")
