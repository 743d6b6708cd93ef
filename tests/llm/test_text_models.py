"""Near duplicates, fingerprints and models: brute force, held-out accuracy, odd inputs."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from delinq.llm import byte_cnn, interp_lm, jaccard_groups, prefix_hash, skip_crf
from delinq.llm.queries import QUERIES

TEXTS = "doc_id long, text string, n string"


@pytest.fixture(scope="module")
def documents(spark, small):
    return {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_components(texts: dict) -> dict:
    sets = {}
    for i, t in texts.items():
        w = words_of(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.random()}"
    return out


@pytest.mark.parametrize("large", [64, 1])
def test_components_equal_brute_force(spark, monkeypatch, large):
    """Groups of near copies, chains, shared passages; also with rounds for all lists."""
    monkeypatch.setattr(jaccard_groups, "LARGE", large)
    rng, texts = random.Random(3), {}
    passage = [f"p{k}" for k in range(60)]
    for g in range(6):
        base = [f"g{g}w{k}" for k in range(rng.choice([6, 40, 120]))]
        for _ in range(rng.choice([2, 8, 15])):
            texts[len(texts)] = " ".join(edited(rng, base, rng.randrange(4)))
        for _ in range(6):  # a chain of ever more edits
            base = edited(rng, base, 1)
            texts[len(texts)] = "\n".join(base).upper()
    for k in range(40):
        texts[len(texts)] = " ".join([f"u{k}x{i}" for i in range(rng.randrange(80))] + passage)
    texts |= {900: None, 901: "", 902: " \t\n", 903: "one two", 904: "ONE\ttwo", 905: "one two three"}
    rows = [(i, t, "x") for i, t in texts.items()] + [(3, texts[3], "x"), (3, texts[3], "x")]
    out = jaccard_groups.cluster(spark.createDataFrame(rows, TEXTS)).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute_components(texts)


def test_common_passages_and_near_misses_are_not_compared(spark, monkeypatch):
    """Also where no shingle stands out among many: passages make no cells, sketches rule near misses out."""
    counts = {}

    def counted(df, name, write=jaccard_groups.written):
        out = write(df, name)
        counts.setdefault(name, out.count())
        return out

    monkeypatch.setattr(jaccard_groups, "written", counted)
    monkeypatch.setattr(jaccard_groups, "frequent_slots", lambda docs: bytes(1 << jaccard_groups.SLOT_BITS - 3))
    rng, texts = random.Random(5), {}
    passage, base = [f"p{k}" for k in range(12)], [f"b{k}" for k in range(200)]
    for k in range(40):
        texts[k] = " ".join([f"u{k}x{i}" for i in range(200)] + passage)
    for k in range(15):  # five edits each: about 0.6 of the shingles of two are common
        texts[100 + k] = " ".join(edited(rng, base, 5))
    texts[200] = texts[100] + " end"
    out = jaccard_groups.cluster(spark.createDataFrame([(i, t, "x") for i, t in texts.items()], TEXTS)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute_components(texts)
    assert counts["cells"] == 0 and 1 <= counts["pairs"] <= 15  # of 120


def test_open_pairs_meet_where_common_shingles_begin(spark):
    rng, n, lists = random.Random(6), 280, []
    for grp in range(25):
        prefix = sorted(rng.sample(range(90), 71))
        lists += [(token, grp, n, pos, 9) for pos, token in enumerate(prefix)]
    lists = spark.createDataFrame(lists, "token long, grp long, n int, pos int, k long")
    comp = {grp: grp if grp > 9 else 0 for grp in range(25)}
    groups = spark.createDataFrame([(g, c, c) for g, c in comp.items()], "grp long, low long, high long")
    met = [(r.xgrp, r.ygrp) for r in jaccard_groups._open_pairs(lists, groups).collect()]
    early = {g: {r.token for r in lists.where(f"grp = {g} and pos <= {n // 7}").collect()} for g in range(25)}
    assert set(met) == {(x, y) for x in early for y in early if x < y and comp[x] != comp[y] and early[x] & early[y]}
    common = sum(len(early[x] & early[y]) for x, y in set(met))
    assert len(set(met)) <= len(met) < 0.7 * common


def test_sketches_differ_no_more_than_sets():
    rng = np.random.default_rng(7)
    for n in (1, 5, 300, 3000):
        x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        y = np.concatenate([x[: n // 2], rng.integers(0, 1 << 63, n, dtype=np.uint64)])
        apart = len(np.setxor1d(x, y))
        for bits in (jaccard_groups.SKETCH, jaccard_groups.WIDE_SKETCH):
            a, b = (jaccard_groups._sketch(t, bits) for t in (x, y))
            assert len(a) == bits // 64 and sum(int(v).bit_count() for v in (a ^ b).view(np.uint64)) <= apart


def test_one_of_each_keeps_one(spark):
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(5, base, "a"), (4, base + " end", "b"), (7, base, "c"), (5, base, "a"), (8, "other text", "d"), (9, None, "e"), (None, "", "f")]
    frame = spark.createDataFrame(rows, TEXTS)
    out = jaccard_groups.one_of_each(frame)
    assert sorted(r.n for r in out.collect()) == ["b", "d", "e", "f"] and out.columns == frame.columns
    assert jaccard_groups.one_of_each(frame.where("false")).count() == 0
    assert jaccard_groups.cluster(frame.where("false")).count() == 0


def test_spans_and_extensions():
    rng = random.Random(2)
    a, b = ("".join(rng.choice("abé\U0001f600") for _ in range(400)) for _ in range(2))
    b = b[:100] + a[50:250] + b[300:]
    x, y = prefix_hash.PrefixHash(a), prefix_hash.PrefixHash(b)
    for _ in range(300):
        i, j, n = rng.randrange(300), rng.randrange(300), rng.randrange(1, 90)
        assert (x.span(i, n) == y.span(j, n)) == (a[i : i + n] == b[j : j + n])
        k = 0
        while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
            k += 1
        assert prefix_hash.common_extension(x, i, y, j) == k
    assert prefix_hash.common_extension(x, 50, y, 100) >= 200


def test_edited_prints_equal_direct_ones():
    rng = random.Random(4)
    texts = ["", "a", "ab", "x" * 500] + ["".join(rng.choice("ab cdé") for _ in range(rng.randrange(200))) for _ in range(60)]
    for a in texts:
        b = rng.choice(texts)
        text, found = prefix_hash.Document(a).edited(prefix_hash.Document(b))
        assert text == a[: len(a) - len(a) // 2] + b[: len(a) // 2]
        assert found.text == prefix_hash.Document(text).fingerprint.text
        assert prefix_hash.read_fingerprint(found.text).text == found.text


def test_prints_of_all_documents(spark, small, documents):
    rows = {r.doc_id: r for r in QUERIES["op7_prefix_hash"](spark, small).collect()}
    order = sorted(documents, reverse=True)
    for i, d in enumerate(order):
        text, other = documents[d].text, documents[order[(i + 1) % len(order)]].text
        half = len(text) // 2
        made = text[: len(text) - half] + other[:half]
        assert rows[d].edited_sha256 == hashlib.sha256(made.encode()).hexdigest() and rows[d].n_chars == len(text)
        assert rows[d].fingerprint == prefix_hash.Document(text).fingerprint.text
    assert np.mean([r.near_edited for r in rows.values()]) > 0.25 > 0.05 > np.mean([r.near_next for r in rows.values()])


def test_prints_keep_64_wide_hashes():
    rng = random.Random(6)
    a, b = ("".join(rng.choice("abcdefgh ") for _ in range(2000)) for _ in range(2))
    x, y = prefix_hash.Document(a), prefix_hash.Document(a[:-100] + b[:100])
    assert len(x.fingerprint.kept) == 64 and len(x.fingerprint.text) == 2 * (16 + 64 * 8)
    assert x.fingerprint.kept.max() > 2**32 and (64 * x.fingerprint.likeness(y.fingerprint)) % 1 == 0


def test_short_texts_are_near_their_edited_forms():
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzé "
    made = lambda n: "".join(rng.choice(letters) for _ in range(n))
    for n in range(2, 130):
        a, b = prefix_hash.Document(made(n)), prefix_hash.Document(made(rng.randrange(1, 300)))
        text, found = a.edited(b)
        assert a.fingerprint.likeness(found) == found.likeness(a.fingerprint) > 0
        written = [prefix_hash.read_fingerprint(x.text) for x in (a.fingerprint, found)]
        assert written[0].likeness(written[1]) == a.fingerprint.likeness(found)
    x, y = "the quick brown fox jumps", "the quick brown dog naps"
    spans = [{t[i : i + 4] for i in range(len(t) - 3)} for t in (x, y)]
    found = prefix_hash.Document(x).fingerprint.likeness(prefix_hash.Document(y).fingerprint)
    assert found == len(spans[0] & spans[1]) / len(spans[0] | spans[1])


@pytest.mark.parametrize("ranges", ["1", "7", "40"])
def test_prints_beside_the_next_in_any_ranges(spark, ranges):
    rng = random.Random(7)
    ids = [rng.randrange(60) for _ in range(90)] + [None] * 5
    rows = [(i, f"text {rng.randrange(10**6)} " * rng.randrange(1, 5), "") for i in ids]
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        out = prefix_hash.with_next(spark.createDataFrame(rows, TEXTS).repartition(3)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    made = []
    for (i, t, _), (_, other, _) in zip(rows, rows[1:] + rows[:1]):
        made.append((str(i), hashlib.sha256((t[: len(t) - len(t) // 2] + other[: len(t) // 2]).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.edited_sha256) for r in out) == sorted(made)


def test_prints_edge_cases(spark):
    rows = [(2, "same text", ""), (1, "same text", ""), (None, None, ""), (None, "", ""), (9, "é" * 100_000, "")]
    frame = spark.createDataFrame(rows, TEXTS).repartition(3)
    out = prefix_hash.with_next(frame).collect()
    assert len(out) == 5 and len({r.fingerprint for r in out if r.doc_id in (1, 2)}) == 1
    assert next(r for r in out if r.doc_id == 2).near_next == 1.0
    assert prefix_hash.with_next(frame.where("doc_id = 2")).first().near_next == 1.0
    assert prefix_hash.with_next(frame.where("false")).count() == 0


def crc(i, m):
    return zlib.crc32(str(i).encode()) % m


def test_scores_equal_plain_model(spark, small, documents, monkeypatch):
    monkeypatch.setattr(interp_lm, "CHUNK_TOKENS", 3000)
    kept = {}
    fit = interp_lm.fit_weights
    monkeypatch.setattr(interp_lm, "fit_weights", lambda *a: kept.setdefault("w", fit(*a)))
    rows = QUERIES["op8_interp_lm"](spark, small).collect()
    tokens = {i: [*words_of(d.text), "<end>"] for i, d in documents.items()}
    one, two, n_docs = Counter(), Counter(), 0
    for i, t in tokens.items():
        if crc(i, 5) != 1:
            one.update(t)
            two.update(zip(["<start>", *t], t))
            n_docs += 1
    n, v = sum(one.values()), len(one)
    for r in rows:
        total = base = 0.0
        for h, w in zip(["<start>", *tokens[r.doc_id]], tokens[r.doc_id]):
            c = n_docs if h == "<start>" else one[h]
            weights = kept["w"][min(int(math.log2(c)) + 1, interp_lm.BUCKETS - 1) if c else 0]
            total += math.log10(weights[0] * (two[h, w] / c if c else 0) + weights[1] * one[w] / n + weights[2] / (v + 1))
            base += math.log10((one[w] + 0.5) / (n + 0.5 * (v + 1)))
        assert r.score == pytest.approx(total) and r.base_score == pytest.approx(base)
        assert (r.train_tokens, r.n_tokens, r.held_out) == (n, len(tokens[r.doc_id]), crc(r.doc_id, 5) == 1)
        assert r.n_known == sum(one[w] > 0 for w in tokens[r.doc_id])
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.2 * sum(r.n_tokens for r in held)
    assert np.allclose(kept["w"].sum(axis=1), 1)


def test_scores_edge_cases(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(1, None, ""), (None, "a b", ""), (2, "A b", ""), (2, "A b", "")], TEXTS)
    out = interp_lm.score(frame, F.col("doc_id") == 2, F.col("doc_id") == 1).collect()
    assert sorted((r.n_tokens, r.n_known) for r in out) == [(1, 1), (3, 3), (3, 3), (3, 3)] and out[0].train_tokens == 6
    none = interp_lm.score(frame, F.lit(False), F.lit(True)).collect()
    assert {r.score for r in none} == {0.0} and len(none) == 4
    assert interp_lm.score(frame.where("false"), F.lit(True), F.lit(False)).count() == 0


def test_network_gradients():
    rng = np.random.default_rng(0)
    net = byte_cnn.ByteNetwork(["a", "b"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    windows, labels = rng.integers(0, 256, (4, byte_cnn.WINDOW)).astype(np.uint8), np.array([0, 1, 1, 0])
    loss = lambda: -np.log(net.probabilities(windows)[np.arange(4), labels]).mean()
    for name, g in net.gradients(windows, labels).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        before, step = loss(), 1e-6
        net.p[name][at] += step
        assert (loss() - before) / step == pytest.approx(g[at], rel=1e-2, abs=1e-5)
        net.p[name][at] -= step


def test_language_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op9_byte_cnn"](spark, sf).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and all(r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_edge_cases(spark):
    frame = spark.createDataFrame([(1, "text here", "en"), (2, None, "en"), (3, "12 !", None), (None, "more " * 9000, None)], "doc_id long, text string, lang string")
    from pyspark.sql import functions as F

    net = byte_cnn.train(frame, F.lit(True))
    assert {r.doc_id: r.lang_pred for r in byte_cnn.predict(frame, net).collect()} == {1: "en", 2: "und", 3: "und", None: "en"}
    assert byte_cnn.train(frame, F.lit(False)) is None
    assert {r.lang_pred for r in byte_cnn.predict(frame, None).collect()} == {"und"}
    assert byte_cnn.predict(frame.where("false"), net).count() == 0


def plain_spans(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda s: re.sub("[^0-9]", "", s)
    out += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and skip_crf.luhn(digits(m[0]))]
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]


def test_base_spans_equal_plain_patterns(documents):
    rng = random.Random(8)
    texts = [d.text for d in documents.values()]
    texts += ["".join(rng.choice("ab1290.@-+ ()_%é") for _ in range(rng.randrange(60))) for _ in range(20_000)]
    texts += ["4111 1111 1111 1111 256.1.1.1 1.2.3.4.5.6.7.8 a@b.c_d@e.f +1 (253) 555-3368", "1" * 20_000, "a" * 20_000 + "@", "1." * 9000]
    for t in texts[:-3]:
        assert skip_crf.base_spans(t) == plain_spans(t), t
    for t in texts[-3:]:
        skip_crf.base_spans(t)


def test_repeated_number_takes_the_kind(spark):
    rows = [(i, f"call +1 (253) 555-{1000 + i} now. word {i} year 2024 and again 253.555.{1000 + i} ok", "x") for i in range(60)]
    rows += [(100 + i, f"nothing but order 7{i:02d}5551{i:03d} here", "x") for i in range(60)] + [(None, None, "x"), (7, rows[7][1], "x")]
    frame = spark.createDataFrame(rows, TEXTS)
    out = skip_crf.find_spans(frame, skip_crf.train(frame)).collect()
    assert len(out) == len(rows)
    for r in out:
        base, spans = [r.n_email, r.n_ip, r.n_card, r.n_phone], r.spans.split(",") if r.spans else []
        assert base == [0, 0, 0, int(r.doc_id is not None and r.doc_id < 100)]
        assert len(spans) == 2 * base[3] and all(s.startswith("phone:") for s in spans)
    assert skip_crf.find_spans(frame.where("false"), skip_crf.train(frame.where("false"))).count() == 0


def weak_model(against, skip):
    node = np.zeros((len(skip_crf.features("", 0, 0)), skip_crf.NONE + 1))
    node[0, skip_crf.NONE] = against  # every candidate alone is nothing
    return skip_crf.SkipChain(node, np.zeros((skip_crf.NONE + 1,) * 2), skip)


@pytest.mark.parametrize("skip", skip_crf.SKIP_BOUNDS)
def test_every_repeat_takes_the_kind_however_distant(skip):
    weak = " ".join(f"word {'abcdefghij'[k % 10]} 253.555.1000 ok" for k in range(50))
    sure = "call +1 (253) 555-1000 now"
    for text in (f"{sure} {weak}", f"{weak} {sure}", f"{weak} {sure} {weak}"):
        base, spans = weak_model(2.5, skip).spans(text)
        assert len(base) == 1 and len(spans) == 1 + text.count("253.555.1000") and all(k == 3 for k, _, _ in spans)


def test_messages_settle():
    """On a chain of distinct candidates the beliefs are exact, however far the evidence."""
    n = 40
    text = "+1 (253) 555-1000 and " + " ".join(f"x 253{k:02d}46{k:02d}" for k in range(10, 10 + n))
    model = weak_model(0.2, 5.0)
    model.chain = 6.0 * np.eye(skip_crf.NONE + 1)
    nodes = skip_crf.mentions(text)
    assert len(nodes) == n + 1
    unary = np.array([skip_crf.features(text, s, e) for _, s, e in nodes]) @ model.node
    unary[0], unary[0, nodes[0][0]] = -60.0, 0.0
    right, left = np.zeros((n + 1, 5)), np.zeros((n + 1, 5))
    for i in range(1, n + 1):
        right[i] = np.logaddexp.reduce((unary[i - 1] + right[i - 1])[:, None] + model.chain, axis=0)
        left[n - i] = np.logaddexp.reduce(model.chain + (unary[n - i + 1] + left[n - i + 1])[None, :], axis=1)
    total = unary + right + left
    exact = np.exp(total - total.max(axis=1, keepdims=True))
    exact /= exact.sum(axis=1, keepdims=True)
    assert np.allclose(model.beliefs(text, nodes), exact, atol=1e-3)


def test_training_counts_all_edges_and_samples_each_label(spark, monkeypatch):
    monkeypatch.setattr(skip_crf, "TRAIN_MENTIONS", 50)
    seen = []
    monkeypatch.setattr(skip_crf, "fit", lambda *a: seen.append(a))
    long = " ".join(f"order {7000000 + k} of" for k in range(400))
    texts = [long, long + " end"] + [f"mail a{k}@b.com or 1.2.3.{k} and a{k}@b.com" for k in range(40)]
    texts += [f"call +1 (253) 555-{1000 + k} by card 4111 1111 1111 1111 or +1 (253) 555-{1000 + k}" for k in range(30)]
    skip_crf.train(spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], TEXTS).repartition(5))
    pairs, follows = np.zeros((5, 5)), np.zeros((5, 5))
    for t in texts:
        nodes = skip_crf.mentions(t)
        edges = skip_crf.skip_edges(t, nodes)
        open_ = {x for e in edges for x, y in (e, e[::-1]) if nodes[x][0] == skip_crf.NONE != nodes[y][0]}
        for a, b in edges:
            if skip_crf.NONE not in (nodes[a][0], nodes[b][0]):
                pairs[nodes[a][0], nodes[b][0]] += 1
        for i in range(1, len(nodes)):
            if not open_ & {i - 1, i}:
                follows[nodes[i - 1][0], nodes[i][0]] += 1
    labels, rows, found_pairs, found_follows = seen[0]
    assert np.array_equal(found_pairs, pairs) and np.array_equal(found_follows, follows)
    assert pairs.sum() >= 70 and follows.sum() > 800
    assert np.bincount(labels, minlength=5).tolist() == [10] * 5 and len(rows) == 50


@pytest.mark.parametrize("at", ["[at]", "(at)", "{at}", " [at] ", "\t{at}\n"])
@pytest.mark.parametrize("dot", ["[dot]", "(dot)", "{dot}", " {dot} ", "."])
def test_spelled_addresses_take_the_kind(at, dot):
    text = f"john@x.com wrote, then john{at}x{dot}com"
    assert skip_crf.features(text, 23, len(text))[3] == 1.0
    assert skip_crf.skip_edges(text, skip_crf.mentions(text)) == [(0, 1)]
    assert weak_model(1.5, 5.5).spans(text)[1] == [(0, 0, 10), (0, 23, len(text))]


def test_masking(spark):
    frame = spark.createDataFrame([(1, "mail a@b.com or 1.2.3.4!", 5), (2, None, None)], "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in skip_crf.mask_documents(frame, skip_crf.train(frame)).collect()}
    assert out[1].text == "mail [EMAIL] or [IP]!" and out[1].n_chars == len(out[1].text) and out[2].text is None
    assert skip_crf.masked("abcdef", [(0, 1, 3), (1, 2, 5)]) == "a[EMAIL]f"


def test_pipeline(spark, small):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = p.run(spark, small)
    assert out.where("not round_trip").count() == 0 and out.count() > 0
    for _, stage in p.STAGES[:-1]:
        assert stage(spark, docs.where("false"), small).columns == docs.columns


def brute_quality(docs: list[dict]) -> list[dict]:
    """Documents that pass the base rules, without the lines that more than 10 and 0.5 % of a source's texts have."""
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    norm = lambda x: re.sub("[0-9]+", "0", re.sub(r"[\x20\x09-\x0D]+", " ", x)).strip().lower()
    having, hosts, out = {}, {}, []
    for d in docs:
        hosts.setdefault(d["source"], set()).add(d["text"])
        for line in filter(split, d["text"].split("\n")):
            having.setdefault((d["source"], norm(line)), set()).add(d["text"])
    for d in docs:
        words, places = split(d["text"]), {}
        for i in range(len(words) - 7):
            places.setdefault(tuple(words[i : i + 8]), []).append(i)
        again = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(8)}
        if len(words) < 20 or 100 * len(again) > 30 * len(words):
            continue
        often = lambda x: len(having.get((d["source"], norm(x)), ())) > max(10, 0.005 * len(hosts[d["source"]]))  # noqa: B023, E731
        text = "\n".join(x for x in d["text"].split("\n") if not (split(x) and often(x)))
        if 2 * len(split(text)) >= len(words):
            out.append(d | {"text": text})
    return out


def test_pipeline_equals_brute_force(spark):
    """Each stage's rows on a small fixture, from what the stage before wrote."""
    import corpus_pipeline as p
    import public_tokenizers
    from test_tokens import whole_search

    from delinq.llm import piece_viterbi
    from delinq.llm.common import written

    rng, docs = random.Random(12), []

    def add(source, text):
        docs.append({"doc_id": len(docs), "text": text, "lang": "en", "source": source, "n_chars": len(text)})

    name = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    body = lambda n=30: " ".join(name() for _ in range(n))
    for k in range(16):
        add("a", f"{body()}\nRead  MORE {k} here\nmail {name()}@example.com or 10.0.{k}.7 now")
    for k in range(10):
        add("b", f"{body()}\nRead more {k} here")  # ten are not too many
    for k in range(6):
        add("c", f"call +1 (253) 555-10{k:02d} {body(60)} and again 253.555.10{k:02d} ok")
    near = body(80)
    for k in range(5):
        add("c", f"{near} {name()}")
    for _ in range(3):
        add("a", docs[2]["text"])
    add("a", body(5))  # too short
    add("b", " ".join([body(10)] * 6))  # repeats itself
    add("a", "Read more 1 here\n" * 12 + body(6))  # depleted or repeating
    frame = spark.createDataFrame([tuple(d.values()) for d in docs], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    rows = {}
    for stage, run in p.STAGES:
        frame = written(run(spark, frame, ""), stage)
        rows[stage] = sorted((r.asDict() for r in frame.collect()), key=lambda r: r["doc_id"])
    plain = lambda found: sorted((r["doc_id"], r["text"], r["source"], r["n_chars"]) for r in found)

    quality = [d | {"n_chars": len(d["text"])} for d in brute_quality(docs)]
    assert len(quality) == len(docs) - 3 and sum(a["text"] != docs[a["doc_id"]]["text"] for a in quality) == 19
    assert plain(rows["quality"]) == plain(quality)

    roots = brute_components({d["doc_id"]: d["text"] for d in quality})
    ids = [r["doc_id"] for r in rows["near_duplicates"]]
    assert sorted(roots[i][1] for i in ids) == sorted({r for _, r in roots.values()}) and len(ids) == 33
    single = {d["doc_id"]: d for d in quality}
    assert plain(rows["near_duplicates"]) == plain(single[i] for i in ids)

    masked = []
    for i in ids:
        spans = plain_spans(single[i]["text"])
        spans += [(3, *m.span()) for m in re.finditer(r"253\.555\.10[0-9]{2}", single[i]["text"])]  # repeats of sure ones
        text = skip_crf.masked(single[i]["text"], spans)
        masked.append(single[i] | {"text": text, "n_chars": len(text)})
    assert sum(m["text"].count("[") for m in masked) == 16 * 2 + 6 * 2
    assert plain(rows["personal_data"]) == plain(masked)

    sizes, order = Counter(), sorted({d["source"] for d in masked})
    for d in masked:
        sizes[d["source"]] += len(d["text"].split())
    level = sum(sizes.values()) / 6
    targets = {s: level * (1, 2, 3)[k] for k, s in enumerate(order)}
    assert order == ["a", "b", "c"] and all(targets[s] < 3 * sizes[s] for s in order)  # no source reaches its cap
    taken, by_id = Counter(), {d["doc_id"]: d for d in masked}
    copies = Counter(r["doc_id"] for r in rows["mixture"])
    assert plain(rows["mixture"]) == sorted(t for d in plain(masked) for t in [d] * copies[d[0]])
    for i, d in by_id.items():
        taken[d["source"]] += copies[i] * len(d["text"].split())
        assert copies[i] - math.floor(targets[d["source"]] / sizes[d["source"]]) in (0, 1)
    assert all(abs(taken[s] - targets[s]) <= max(len(d["text"].split()) for d in masked if d["source"] == s) for s in order)

    pieces = piece_viterbi.pieces(public_tokenizers.path(p.MODEL))
    assert [r["doc_id"] for r in rows["pieces"]] == [r["doc_id"] for r in rows["mixture"]]
    for r in rows["pieces"]:
        text = by_id[r["doc_id"]]["text"]
        assert list(r["ids"]) == whole_search(pieces, " " + text) and r["round_trip"] and r["n_ids"] == len(r["ids"])


def test_convolution_by_look_up_equals_plain_one():
    """The look-up form of the filters against sums over bytes, embeddings and places."""
    rng = np.random.default_rng(2)
    net = byte_cnn.ByteNetwork(["a", "b", "c"])
    windows = rng.integers(0, 256, (2, byte_cnn.WINDOW)).astype(np.uint8)
    features = []
    for k in byte_cnn.WIDTHS:
        w, b = net.p[f"w{k}"].reshape(k, byte_cnn.EMBED, byte_cnn.FILTERS), net.p[f"b{k}"]
        answers = np.array(
            [[sum(net.p["embed"][row[at + j]] @ w[j] for j in range(k)) + b for at in range(byte_cnn.WINDOW - k + 1)] for row in windows]
        )
        assert np.allclose(net._pooled(windows, k), answers, atol=1e-4)
        features.append(np.maximum(answers.max(axis=1), 0))
    z = np.concatenate(features, axis=1) @ net.p["out"] + net.p["bias"]
    e = np.exp(z - z.max(axis=1, keepdims=True))
    assert np.allclose(net.probabilities(windows), e / e.sum(axis=1, keepdims=True), atol=1e-5)


@pytest.mark.parametrize("planned", [1000, 1])
def test_small_languages_are_learned(spark, monkeypatch, planned):
    """Many documents of one language leave the few of another in the sample, at most PER_LANG or so of the first."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(byte_cnn, "PER_LANG", 20)
    monkeypatch.setattr(byte_cnn, "MAX_WINDOWS", 30)
    monkeypatch.setattr(byte_cnn, "PLANNED", planned)
    seen = []
    monkeypatch.setattr(byte_cnn.ByteNetwork, "fit", lambda self, windows, labels: seen.append([self.langs[i] for i in labels]))
    rows = [(i, f"text {i} " * 60, "big") for i in range(2000)] + [(5000 + i, f"wort {i}", "small") for i in range(5)]
    byte_cnn.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert seen[0].count("small") == 5 and 5 <= seen[0].count("big") <= 25
