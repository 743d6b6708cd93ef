"""Given columns named like the operators' own, and very long texts."""

from __future__ import annotations

import pytest

from delinq.llm import filter_audit, jaccard_groups, pivotal_mix, quality_lines

NAMES = ["_row", "_n", "_time", "_removed", "_text", "_facts", "_row_key", "_key", "key", "given", "new", "gone", "host", "cls", "copies", "a.b"]
KIND = "doc_id long, text string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)


@pytest.fixture(scope="module")
def docs(spark):
    name = lambda i: "abcdefghij"[i // 10] + "abcdefghij"[i % 10]  # noqa: E731  digits count as equal
    body = lambda i: " ".join(f"{name(i)}x{name(k)}" for k in range(40))
    rows = [(i, body(i), "s", 1, *[f"{n}{i}" for n in NAMES]) for i in range(30)]
    return spark.createDataFrame(rows, KIND)


@pytest.mark.parametrize("run", [quality_lines.filter_documents, jaccard_groups.one_of_each, pivotal_mix.mix_documents])
def test_given_columns_come_back(docs, run):
    out = run(docs)
    assert out.columns == docs.columns
    want = {r.doc_id: tuple(r)[4:] for r in docs.collect()}
    rows = out.collect()
    assert rows and all(tuple(r)[4:] == want[r.doc_id] for r in rows)


def test_queries_take_clashing_columns(docs):
    assert quality_lines.assess(docs).count() == 30
    assert jaccard_groups.cluster(docs).count() == 30
    assert pivotal_mix.mix(docs).count() == 30


def test_very_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, long, "s"), (2, long + " end", "s"), (3, "x" * 2_000_000, "s"), (4, "short text", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_groups.cluster(docs).collect()} == {
        1: (199_996, 1), 2: (199_997, 1), 3: (1, 3), 4: (1, 4)
    }
    assert {r.doc_id: r.n_words for r in quality_lines.assess(docs).collect()} == {1: 200_000, 2: 200_001, 3: 1, 4: 2}
    assert {r.doc_id: r.size for r in pivotal_mix.mix(docs).collect()} == {1: 200_000, 2: 200_001, 3: 1, 4: 2}
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sum(r.n for r in filter_audit.failures(docs, labels).collect()) == 4
