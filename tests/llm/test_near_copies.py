"""SimHash by byte positions: library hash, brute force over all pairs, long lists, odd inputs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from delinq.llm import simhash_bytes
from delinq.llm.components import components
from delinq.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_print(text: str | None) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    width = min(3, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + width]).encode(), seed=42).intdigest() for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[int]) -> dict[int, int]:
    """Each print's least reachable print, by comparing every one with every other."""
    all_prints = np.unique(np.array(prints, np.uint64))
    root = {int(p): int(p) for p in all_prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p in all_prints:
        for other in all_prints[np.bitwise_count(all_prints ^ p) <= 2]:
            a, b = sorted((find(int(p)), find(int(other))))
            root[b] = a
    return {p: find(p) for p in root}


def check(rows, texts: dict[int, str | None]):
    prints = {i: plain_print(t) for i, t in texts.items()}
    roots = plain_components(list(prints.values()))
    least: dict[int, int] = {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{p:016x}", least[roots[p]]) for i, p in prints.items()
    }


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check(QUERIES["op11_simhash_bytes"](spark, SF).collect(), {r.doc_id: r.text for r in docs})


def test_spark_hash_is_the_same(spark):
    text = "ärger im haus"  # one shingle; Spark's own XXH64 has the same seed
    own = spark.range(1).select(F.xxhash64(F.lit(text)).alias("h")).first().h
    assert simhash_bytes.fingerprint(text.encode()) == own % (1 << 64)


@pytest.mark.parametrize("limit", [2, 8, 128])
def test_links_join_what_all_pairs_join(spark, monkeypatch, limit):
    """A dense family around one print and strangers, with short and long lists."""
    monkeypatch.setattr(simhash_bytes, "LIST", limit)
    rng = random.Random(limit)
    seeds = [rng.getrandbits(64) for _ in range(3)]
    prints = {s ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (1 << 64) - 1 for s in seeds for _ in range(150)}
    prints |= {rng.getrandbits(64) for _ in range(300)} | {seeds[0] ^ b for b in range(300)}
    signed = [int(x) for x in np.array(sorted(prints), np.uint64).view(np.int64)]
    classes = spark.createDataFrame([(x,) for x in signed], "cls long")
    found = {r.cls % (1 << 64): r.comp % (1 << 64) for r in components(simhash_bytes.links(classes)).collect()}
    want = plain_components(list(prints))
    groups = {}
    for p, r in want.items():
        groups.setdefault(r, set()).add(p)
    got = {}
    for p in prints:
        got.setdefault(found.get(p, p), set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_every_value_of_two_bytes():
    """The longest list there can be: all 2^16 members, one component."""
    members = (np.arange(1 << 16, dtype=np.uint64) << np.uint64(16)) | np.uint64(0xAB00000000001234)
    a, b = simhash_bytes.list_links(members.view(np.int64), (0, 1, 4, 5, 6, 7))
    assert len(a) == (1 << 16) - 1 and (b == members.view(np.int64).min()).all()


def test_odd_inputs(spark):
    long = " ".join(f"w{i}" for i in range(150_000))
    texts = {1: None, 2: "", 3: " \t\n", 4: "one", 5: "ONE", 6: "one two", 7: long, 8: long + " end", 9: "a b c d"}
    kind = "doc_id long, text string, cls string, fingerprint int, component_id int, kept int"
    docs = spark.createDataFrame([(i, t, "x", 0, 0, 0) for i, t in texts.items()], kind)
    check(simhash_bytes.near_duplicates(docs).collect(), texts)
    more = spark.createDataFrame([(None, "a b c d"), (9, "a b c d"), (9, "a b c d"), (None, "none at all")], "doc_id long, text string")
    rows = simhash_bytes.near_duplicates(more).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in rows) == [(0, 0), (0, 9), (9, 9), (9, 9)]
    assert simhash_bytes.near_duplicates(docs.limit(0)).collect() == []
