"""Document fingerprints from prefix polynomial hashes.

For a text c[0..n) and a modulus P the prefix array holds S[i] = sum of c[j] * B^j for j < i. The difference of
two entries, divided by B^i, is the hash of the span between them, so any two spans are compared in constant
time and the longest common extension of two positions is found by binary search. Two moduli below 2^31 keep all
products in 64 bits; together they give 62-bit hashes.

A fingerprint keeps the hash of the whole text, its length and the ``KEEP`` smallest distinct mixed hashes of its
spans of ``SPAN`` characters (the whole text, if shorter). Texts of less than 96 characters keep those of their spans
of 4 characters too, texts of less than 8 also those of single characters (``SHORT``). Likeness is the share of common
spans among the smallest of both, 1 for equal texts; it takes the spans of the shortest length that both texts keep, so
both sides follow one rule. Spans of a text put together from two others come from their prefix arrays; only the
spans across the seam are hashed anew.

``with_next`` puts every document beside the next one by descending doc_id with one sort of the texts by ranges.
The bounds of the ranges and the first text of each are found first; that text also goes to the end of the range
before, so every range settles all its rows and no prints are written in between.

Defined results: null text is empty; rows without doc_id come last; equal doc_ids stand in the order of their
texts; a single row is its own next; an empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delinq.llm.common import written

#: Parameters of the hash: moduli (primes below 2^31) and bases.
MODULI = (2147483647, 2147483629)
BASES = (911382323, 972663749)
SPAN = 24
KEEP = 64
#: Below so many characters spans of this length are kept too, so that a text of which half stays shares some.
SHORT = ((8, 1), (96, 4))

_POWERS: list[list[np.ndarray]] = [[np.ones(1, np.uint64)] * 2 for _ in MODULI]


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^0..B^n and their inverses, kept per worker for the longest text so far (doubling)."""
    if len(_POWERS[which][0]) <= n:
        mod, tables = MODULI[which], []
        for base in (BASES[which], pow(BASES[which], -1, MODULI[which])):
            out = np.ones(1, np.uint64)
            while len(out) <= n:
                out = np.concatenate([out, out * np.uint64(pow(base, len(out), mod)) % np.uint64(mod)])
            tables.append(out)
        _POWERS[which] = tables
    forward, inverse = _POWERS[which]
    return forward, inverse


class PrefixHash:
    """Prefix arrays of one text."""

    def __init__(self, text: str):
        self.codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
        self.n = len(self.codes)
        self.sums = []
        for which, mod in enumerate(MODULI):
            terms = self.codes * _powers(which, self.n)[0][: self.n] % np.uint64(mod)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms) % np.uint64(mod)]))

    def spans(self, starts: np.ndarray, length: int) -> np.ndarray:
        """62-bit hashes of the spans of one length that begin at ``starts``."""
        parts = []
        for which, mod in enumerate(MODULI):
            m, s = np.uint64(mod), self.sums[which]
            parts.append((s[starts + length] + m - s[starts]) % m * _powers(which, self.n)[1][starts] % m)
        return parts[0] << np.uint64(31) | parts[1]

    def span(self, start: int, length: int) -> int:
        return int(self.spans(np.array([start]), length)[0])

    def windows(self, length: int) -> np.ndarray:
        return self.spans(np.arange(max(self.n - length + 1, 0)), length)


def common_extension(a: PrefixHash, i: int, b: PrefixHash, j: int) -> int:
    """How many characters from a[i] and from b[j] on are the same."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, middle) == b.span(j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def smallest(hashes: np.ndarray) -> np.ndarray:
    """The KEEP smallest distinct values after mixing, sorted."""
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    if len(mixed) > 4 * KEEP:
        few = np.unique(np.partition(mixed, 4 * KEEP)[: 4 * KEEP])
        if len(few) >= KEEP:
            return few[:KEEP]  # else many spans are equal
    return np.unique(mixed)[:KEEP]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common spans, from the KEEP smallest of both."""
    both = np.union1d(a, b)[:KEEP]
    if not len(both):
        return 1.0
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True), assume_unique=True).mean())


class Fingerprint:
    """Whole hash, length and smallest span hashes, for a short text also those of its shorter spans by length;
    ``text`` is its written form, ``data`` the same in bytes."""

    def __init__(self, whole: int, n: int, kept: np.ndarray, short: dict[int, np.ndarray] | None = None):
        self.whole, self.n, self.kept, self.short = whole, n, kept, short or {}

    @property
    def data(self) -> bytes:
        parts = [np.array([self.whole, self.n], np.uint64)]
        for _, length in _short(self.n):
            parts += [np.array([len(self.short[length])], np.uint64), self.short[length]]
        return np.concatenate([*parts, self.kept]).astype(">u8").tobytes()

    @property
    def text(self) -> str:
        return self.data.hex()

    def likeness(self, other: Fingerprint) -> float:
        if (self.whole, self.n) == (other.whole, other.n):
            return 1.0
        for _, length in _short(max(self.n, other.n)):
            return likeness(self.short[length], other.short[length])
        return likeness(self.kept, other.kept)


def _short(n: int) -> list[tuple[int, int]]:
    """The entries of SHORT for a text of n characters."""
    return [(below, length) for below, length in SHORT if n < below]


def read_fingerprint(text: str) -> Fingerprint:
    values = np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)
    (whole, n), values, short = values[:2].tolist(), values[2:], {}
    for _, length in _short(n):
        size = int(values[0])
        short[length], values = values[1 : size + 1], values[size + 1 :]
    return Fingerprint(whole, n, values, short)


class Document:
    """A text with its prefix arrays and fingerprint."""

    def __init__(self, text: str):
        self.text = text
        self.hash = PrefixHash(text)
        self.windows = self.hash.windows(SPAN)
        self.fingerprint = self._print(self.hash, self.windows)

    @staticmethod
    def _print(whole: PrefixHash, windows: np.ndarray) -> Fingerprint:
        own = whole.span(0, whole.n) if whole.n else 0
        kept = windows if len(windows) else np.array([own] if whole.n else [], np.uint64)
        return Fingerprint(own, whole.n, smallest(kept), {length: smallest(whole.windows(length)) for _, length in _short(whole.n)})

    def edited(self, other: Document) -> tuple[str, Fingerprint]:
        """The last floor(n/2) characters replaced by as many first ones of ``other`` (or all of them)."""
        kept = self.hash.n - self.hash.n // 2
        taken = min(self.hash.n // 2, other.hash.n)
        text = self.text[:kept] + other.text[:taken]
        n = kept + taken
        if n < SPAN or _short(n):
            whole = PrefixHash(text)
            return text, self._print(whole, whole.windows(SPAN))
        seam = PrefixHash(text[max(kept - SPAN + 1, 0) : kept + min(SPAN - 1, taken)]).windows(SPAN)
        own = self.windows[: max(kept - SPAN + 1, 0)]
        theirs = other.windows[: max(taken - SPAN + 1, 0)]
        whole = 0
        for which, mod in enumerate(MODULI):  # the hash of the whole from both prefix arrays
            shift = int(_powers(which, kept)[0][kept])
            part = (int(self.hash.sums[which][kept]) + int(other.hash.sums[which][taken]) * shift) % mod
            whole = whole << 31 | part
        return text, Fingerprint(whole, n, smallest(np.concatenate([own, seam, theirs])))


_COLUMNS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.binary()),
        ("fingerprint", pa.binary()),
        ("edited_fingerprint", pa.binary()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("common_next", pa.int64()),
    ]
)
_RESULT = (
    "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary,"
    " near_edited double, near_next double, common_next long"
)


def compare(doc_id, doc: Document, other: Document) -> tuple:
    text, edited = doc.edited(other)
    return (
        doc_id,
        doc.hash.n,
        hashlib.sha256(text.encode()).digest(),
        doc.fingerprint.data,
        edited.data,
        doc.fingerprint.likeness(edited),
        doc.fingerprint.likeness(other.fingerprint),
        common_extension(doc.hash, 0, other.hash, 0),
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows follower, doc_id, text by range: compare each with the next, up to the follower that ends the range."""
    before, before_id, out = None, None, []
    for batch in batches:
        for follower, doc_id, text in zip(*batch.columns):
            doc = Document(text.as_py())
            if before is not None:
                out.append(compare(before_id, before, doc))
            before, before_id = (None, None) if follower.as_py() else (doc, doc_id.as_py())
            if len(out) >= 256:
                yield _batch(out, _COLUMNS)
                out = []
    yield _batch(out, _COLUMNS)


def _range_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are above doc_id, by binary search; null comes after all."""
    if not bounds:
        return F.lit(0)
    known = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(2**k) for k in reversed(range(len(bounds).bit_length()))])
    upto = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(known, at + step - 1) <= doc_id, at + step).otherwise(at),
    )
    return F.lit(len(bounds)) - upto


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts, of their edited forms, and how near they are to those and to the next text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit(k / ranges) for k in range(1, ranges)])
    found = texts.agg(F.percentile_approx("doc_id", shares, 100 * ranges)).first()[0] if ranges > 1 else None
    dealt = texts.withColumn("part", _range_of(F.col("doc_id"), sorted(set(found or []))))
    firsts = dealt.groupBy("part").agg(F.max("doc_id").alias("first_id"))  # a row a range
    parts = written(firsts, "firsts")
    before = F.coalesce(F.lag("part").over(Window.orderBy("part")), F.max("part").over(Window.partitionBy()))
    ends = parts.select(F.col("part").alias("_part"), "first_id", before.alias("before"))
    same = (F.col("part") == F.col("_part")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    followers = dealt.join(F.broadcast(ends), same).groupBy("before").agg(F.min("text").alias("text"))
    rows = dealt.select("part", F.lit(False).alias("follower"), "doc_id", "text").unionByName(
        followers.select(
            F.col("before").alias("part"), F.lit(True).alias("follower"), F.lit(None).cast("long").alias("doc_id"), "text"
        )
    )
    order = ("part", "follower", F.desc_nulls_last("doc_id"), "text")
    sorted_rows = rows.repartitionByRange("part").sortWithinPartitions(*order)
    out = sorted_rows.select("follower", "doc_id", "text").mapInArrow(_along, _RESULT)
    return out.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})
