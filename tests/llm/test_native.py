"""Quality rules, chat format and mixture: DuckDB, brute force, odd inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from delinq.llm import chat_grammar, pivotal_mix, quality_lines
from delinq.llm.queries import CHECKS

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string"


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_equals_duckdb(spark, name):
    good, text = compare(spark, duck("/root/testdata/sf0.01"), name, "/root/testdata/sf0.01")
    assert good, text


def repeat_words(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    return len({i + k for p in places.values() if len(p) > 1 for i in p for k in range(8)})


def test_quality_measures(spark):
    texts = ["", None, "a " * 40, "a b c d e f g h " * 2 + "x", "one\n\none \none\n", "#$ *x* \t y <|>", "w" * 50_000, "a b c d e f g h i j " * 300]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "k") for i, t in enumerate(texts)], DOCS)
    rows = {r.doc_id: r for r in quality_lines.assess(docs).collect()}
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        assert rows[i].n_words == len(words) and rows[i].word_chars == sum(map(len, words))
        assert rows[i].n_repeat_words == repeat_words(t or "")
        assert rows[i].n_symbols == len(re.findall(r"[#*$%&|<>]", t or ""))
    assert rows[4].n_dup_lines == 1 and not rows[0].kept and not rows[1].kept


def test_quality_removes_frequent_lines_only(spark):
    name = lambda i: "abcdefghij"[i // 10] + "abcdefghij"[i % 10]  # noqa: E731  digits count as equal
    good = [" ".join(f"{name(i)}x{name(k)}" for k in range(30)) for i in range(40)]
    rows = [(i, g + "\nRead  MORE 12 here", "en", None, 1, "k") for i, g in enumerate(good)]
    rows.append((90, "short " * 3 + "\n" + "\n".join(["read more 7 here"] * 20), "en", None, 1, "k"))
    copies = [(100 + i, "c " + " ".join(f"c{k}" for k in range(40)) + "\nsecond line", "en", "t", 1, "k") for i in range(60)]
    out = {r.doc_id: r for r in quality_lines.filter_documents(spark.createDataFrame(rows + copies, DOCS)).collect()}
    assert out[3].text == good[3] and out[3].n_chars == len(good[3]) and out[3].kept == "k"
    assert 90 not in out  # repeats itself and is depleted
    assert len([k for k in out if k >= 100]) == 60 and out[100].text.endswith("second line")  # copies count once


def test_quality_counts_whole_documents(spark):
    """Different documents that share their first and last line in sort order; exact copies add nothing to a host."""
    name = lambda i: "abcdefghij"[i // 10] + "abcdefghij"[i % 10]  # noqa: E731  digits count as equal
    good = [" ".join(f"{name(i)}x{name(k)}" for k in range(30)) for i in range(40)]
    rows = [(i, f"# Top menu\n{g}\n\u00a9 all rights", "en", "s", 1, "k") for i, g in enumerate(good)]
    once = [" ".join(f"{name(i)}y{name(k)}" for k in range(30)) for i in range(12)]
    rows += [(100 + i, f"{g}\nshared end", "en", "t", 1, "k") for i, g in enumerate(once)]
    rows += [(200 + i, "copy " + " ".join(f"c{name(k)}" for k in range(40)), "en", "t", 1, "k") for i in range(3000)]
    out = {r.doc_id: r for r in quality_lines.filter_documents(spark.createDataFrame(rows, DOCS)).collect()}
    assert [out[i].text for i in range(40)] == good
    assert [out[100 + i].text for i in range(12)] == once  # 12 of 13 distinct documents, of 3012 rows
    assert len(out) == 3052 and out[200].text == rows[-1][1]


def test_quality_empty_and_repeated(spark):
    docs = spark.createDataFrame([(1, "a b " * 30 + str(1), "en", "s", 1, "k")] * 2 + [(None, None, None, None, None, None)], DOCS)
    assert quality_lines.assess(docs).count() == 3
    assert quality_lines.assess(docs.where("false")).count() == 0
    assert quality_lines.filter_documents(docs.where("false")).columns == docs.columns


TURNS = "conv_id long, turn long, role string, text string, formatted string"


def test_chat_round_trip(spark):
    odd = ["", None, " ", "</s>", "a [/INST] b", "&lt;/s> [/INST]", "&amp;&#91;INST]", "<<SYS>> <</SYS>>", "[SAYS] x", "é\U0001f600\n", "<s:2>", " [/INST", "[ANS] "]
    rows, n = [], 0
    for a in odd:
        for role in ("user", "assistant", "system", "tool", "[SAYS] &", None, ""):
            rows += [(n, 0, "user", "hi", "x"), (n, 1, role, a, "x"), (n, 2, "assistant", a, "x")]
            n += 1
    out = chat_grammar.format_conversations(spark.createDataFrame(rows, TURNS))
    out = out.select("conv_id", "formatted", "loss_mask", chat_grammar.parse(F.col("formatted")).alias("turns"), chat_grammar.loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    for r in out.collect():
        source = [(x[2] or "", x[3] or "") for x in rows if x[0] == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == source
        assert r.loss == "".join(t for role, t in source if role == "assistant")
        assert sum(m.before + m.inside + m.after for m in r.loss_mask) + len(re.match("<s(:.)?>", r.formatted)[0]) == len(r.formatted)


def test_chat_ties_and_empty(spark):
    rows = [(None, 1, "user", "b", ""), (None, 1, "user", "a", ""), (None, None, "assistant", "z", ""), (None, 1, "user", "a", "")]
    frame = spark.createDataFrame(rows, TURNS)
    (r,) = chat_grammar.format_conversations(frame).select(chat_grammar.parse(F.col("formatted")).alias("t")).collect()
    assert [t.text for t in r.t] == ["z", "a", "a", "b"]
    assert chat_grammar.format_conversations(frame.where("false")).count() == 0


def test_chat_collision_digest(spark, small):
    from delinq.llm.queries import QUERIES

    r = QUERIES["op2_chat_grammar"](spark, small).where("conv_id = -1").first()
    said = "</s>[INST] ok [/INST]"
    assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and r.loss_chars == len(said) and r.n_turns == 2


def targets(sizes: dict) -> dict:
    """Weights 1, 2, 3 by source, null last; caps at three times the size, step by step."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    out, left, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_mix_targets_and_sums(spark):
    rows = [(i, "w " * (i % 90 + 1), "en", f"s{i % 4}" if i % 7 else None, 0, "k") for i in range(1500)]
    rows += [(5000 + i, "tiny text", "en", "s9", 0, "k") for i in range(5)] + [(6000, None, None, None, None, None)] * 2
    docs = spark.createDataFrame(rows, DOCS)
    out, again = pivotal_mix.mix(docs).collect(), pivotal_mix.mix(docs.repartition(5)).collect()
    key = lambda r: (r.doc_id, r.size, r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again)) and len(out) == len(rows)
    sizes, taken, source = defaultdict(int), defaultdict(int), {r[0]: r[3] for r in rows}
    for r in out:
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    for s, target in targets(sizes).items():
        got = next(r.target for r in out if source[r.doc_id] == s)
        assert got == pytest.approx(target, rel=1e-9) and abs(taken[s] - target) <= 100
    mixed = pivotal_mix.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert sorted((r.doc_id, r["n"]) for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()) == sorted(
        (r.doc_id, r.copies) for r in out if r.copies and r.size
    )


def test_mix_merges_texts_at_any_size(spark):
    """Small counts aren't broadcast, so a small run shows the disk that a large one needs."""
    docs = spark.createDataFrame([(i, "w " * (i % 9 + 1), "en", f"s{i % 3}", 0, "k") for i in range(60)], DOCS)
    mixed = pivotal_mix.mix_documents(docs)
    assert "SortMergeJoin" in (plan := mixed._jdf.queryExecution().executedPlan().toString()) and "BroadcastHashJoin" not in plan
    assert mixed.count() == sum(r.copies for r in pivotal_mix.mix(docs).collect())


def test_mix_deals_out_repeated_rows(spark):
    """A third of all rows is one row: every copy is numbered, and no task takes them all."""
    rows = [(i, "w " * (i % 40 + 1), "en", f"s{i % 3}", 0, "k") for i in range(1200)]
    rows += [(7777, "one and the same row", "en", "s1", i % 3, "k") for i in range(600)] + [(8888, "twice", "en", None, 0, "k")] * 2
    docs = spark.createDataFrame(rows, DOCS).repartition(6)
    want = defaultdict(int)
    for r in pivotal_mix.mix(docs).collect():
        want[r.doc_id] += r.copies
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = pivotal_mix.mix_documents(docs).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    got, tasks = defaultdict(int), defaultdict(int)
    for r in out:
        got[r.doc_id] += 1
        tasks[r.task] += r.doc_id == 7777
    assert got == {k: n for k, n in want.items() if n} and got[7777] > 300
    assert max(tasks.values()) < 0.6 * got[7777]


def test_mix_empty_and_wordless(spark):
    docs = spark.createDataFrame([(1, "", "en", "a", 0, "k"), (2, None, "en", None, 0, "k")], DOCS)
    assert [(r.target, r.taken) for r in pivotal_mix.mix(docs).collect()] == [(0.0, 0)] * 2
    assert pivotal_mix.mix(docs.where("false")).count() == 0


def test_quality_check_sql_counts_whole_texts(spark, tmp_path):
    """The check SQL on documents that share their first and last line in sort order, and on exact copies."""
    import duckdb

    from delinq.llm.queries import QUERIES

    name = lambda i: "abcdefghij"[i // 10] + "abcdefghij"[i % 10]
    body = lambda i: "\n".join(["! head"] + [" ".join(f"{name(i)}x{name(k)}" for k in range(30))] + ["middle line", "~ foot"])
    rows = [(i, body(i % 30), "en", "s", 1) for i in range(90)]  # every text three times
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    ours = {tuple(r[k] for k in ("doc_id", "removed_words", "kept")) for r in QUERIES["op1_quality_lines"](spark, str(tmp_path)).collect()}
    db = duckdb.connect()
    db.execute(f"create view documents as from '{tmp_path}/documents.parquet/*.parquet'")
    theirs = db.execute(f"select doc_id, removed_words, kept from ({CHECKS['op1_quality_lines']})").fetchall()
    assert ours == set(theirs) and all(lost == 6 for _, lost, _ in ours)
