"""Filter audit and periodic runs: step-by-step filtering, brute force over all periods, odd inputs."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import permutations
from math import factorial

import numpy as np
import pytest

from delinq.llm import filter_audit, periodic_runs
from delinq.llm.q13_runs import with_periodic_end
from delinq.llm.queries import QUERIES

DOCS = "doc_id long, text string, source string, part string, mask int, n long, good int"
LABELS = "doc_id long, quality int, toxic int, part string"


def plain_masks(rows):
    """Letters each row fails, by the rules as stated."""
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = ""
        fails += "A" if len(words) < 50 else ""
        fails += "B" if 100 * len(set(words)) < 65 * len(words) else ""
        fails += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
        fails += "D" if re.search(r"[#$%&*|]", text) else ""
        smaller = doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, *_ in rows)
        out.append(fails + ("E" if smaller else ""))
    return out


def plain_audit(rows, labels):
    good = {d for d, q, _, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t, _ in labels if t == 1 and d is not None}
    masks, out = plain_masks(rows), {}
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], m) for r, m in zip(rows, masks) if (r[2] or "") == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = own, []
            for step, f in enumerate(order, 1):
                out_now = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                removed_by[f] += len(out_now)
                out[part, "".join(order), step] = [
                    len(left), len(out_now), sum(f in m for _, m in gone), sum(m == f for _, m in own),
                    sum(d in good for d, _ in out_now), sum(d in toxic for d, _ in out_now), f,
                ]
                gone = gone + out_now
        for key, row in out.items():
            if key[0] == part:
                row[6] = removed_by[row[6]]
    return out


def long_text(i):
    return " ".join(f"w{i}x{k}" for k in range(60))


ODD_DOCS = [
    (1, None, None), (2, "", ""), (3, long_text(1), "a"), (4, long_text(1), "b"), (4, long_text(1), "b"), (5, long_text(2) + " #", "a"),
    (6, "same " * 60, "a"), (7, long_text(3).upper(), "a"), (None, long_text(1), "a"), (None, None, None), (8, "w " * 200_000, "é"),
    (9, long_text(4), "a"), (10, " \t\n", "b"), (3, long_text(1), "a"), (11, "é" * 3 + " Ab", "b"),
]


def test_audit_equals_step_by_step(spark):
    rows = [(*r, "clash", 0, 0, 0) for r in ODD_DOCS]
    labels = [(3, 1, 0, "x"), (4, 0, 1, "x"), (4, 1, None, "x"), (6, None, 1, "x"), (None, 1, 1, "x"), (77, 1, 1, "x")]
    got = filter_audit.audit(filter_audit.failures(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)))
    want = plain_audit(rows, labels)
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r.part, r.filter_order, r.step): [r[c] for c in columns] for r in got.collect()} == want


def test_audit_of_nothing(spark):
    cells = filter_audit.failures(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS))
    assert filter_audit.audit(cells).collect() == []


@pytest.mark.parametrize("k", [1, 3, 5])
def test_path_counts(k):
    reach, leave = filter_audit.path_counts(k)
    for state in range(1 << k):
        size = state.bit_count()
        assert (reach[state], leave[state]) == (factorial(size), factorial(k - size))


def plain_runs(words):
    """Every period tried at every place."""
    n, out = len(words), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(12, 2 * q):
                x = words[i : i + length]
                if not any(all(x[k] == x[k + p] for k in range(length - p)) for p in range(1, q)):
                    out.add((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng, found = random.Random(1), 0
    for _ in range(1500):
        n, k = rng.randint(0, 90), rng.choice([1, 2, 2, 3, 5])
        words = [rng.randrange(k) for _ in range(n)]
        if n > 20 and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            words = words[:a] + [words[a + i % p] for i in range(n - a)]
        want = plain_runs(words)
        assert periodic_runs.find_runs(words) == want, words
        found += len(want)
    assert found > 500


def test_runs_without_cutting_first():
    """The automaton on whole texts gives what it gives on stretches."""
    rng = random.Random(2)
    for _ in range(100):
        block = [rng.randrange(50) for _ in range(rng.randint(1, 20))]
        words = [rng.randrange(50) for _ in range(30)] + block * rng.randint(1, 4) + [rng.randrange(50) for _ in range(30)] + block * 2
        assert sorted(periodic_runs._runs_of(words), key=lambda r: (r[0], r[2])) == periodic_runs.find_runs(words)


def test_long_texts():
    assert periodic_runs.find_runs(["a"] * 30_000) == [(0, 30_000, 1)]
    fib, last = ["a", "b"], ["a"]
    while len(fib) < 3000:
        fib, last = fib + last, fib
    runs = periodic_runs.find_runs(fib)
    x = np.array([w == "a" for w in fib])
    for s, length, q in runs:
        assert (x[s : s + length - q] == x[s + q : s + length]).all() and length >= 2 * q
        assert s == 0 or x[s - 1] != x[s - 1 + q]
        assert s + length == len(x) or x[s + length] != x[s + length - q]
    assert len(runs) == len(set(runs)) > 100


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    docs = [(i, " \t".join(rng.choice("abcdefgh") * rng.choice([1, 3]) for _ in range(rng.randrange(160))), 0, "x") for i in range(300)]
    docs += [(400, None, 0, "x"), (401, "", 0, "x"), (402, "one", 0, "x"), (None, "a b " * 20, 0, "x"), (403, "é ü " * 9, 0, "x"), (403, "é ü " * 9, 0, "x")]
    spark.createDataFrame(docs, "doc_id long, text string, runs int, collapsed string").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(str(tuple(r)) for r in out) == sorted(str((i, *plain_row(i, t))) for i, t, *_ in docs)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(300)) > 15 and with_periodic_end([], 3) == []
    assert periodic_runs.analyse(spark.createDataFrame([], "doc_id long, text string")).collect() == []
