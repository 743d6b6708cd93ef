"""Personal data by patterns and a skip-chain conditional random field.

Patterns find the sure spans of four kinds. They and weaker candidates (number groups, spelled-out addresses) are
the nodes of one graph per document: neighbours are joined by chain edges, and candidates with the same or similar
content (equal text, or equal last seven digits) by skip edges, each to its previous occurrence and each candidate
also to the first sure one, however distant.
Labels are the kinds and ``none``. Node weights are trained by logistic regression on the sure spans and the
candidates without a skip edge to one, at most ``TRAIN_MENTIONS`` of them, as many of each label, chosen by a hash per
mention; edge weights come from how often joined nodes agree in all documents. Sure spans keep their label; loopy sum-product messages
carry it along the edges until they settle, and a candidate that ends as a kind with a belief of ``BELIEF`` or more is added.

Every document is one row's work; edges grow linearly with its candidates.

Defined results: null text is empty and has no spans; candidates that overlap a sure span are not nodes of their
own; repeated rows are treated one by one; an empty table gives an empty table. Other columns pass through
``mask_documents``.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delinq.llm.common import written

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
TRAIN_MENTIONS = 5000
#: Messages have settled when none changes by more; rounds are bounded by a multiple of the nodes.
TOLERANCE, ROUNDS_PER_NODE, MIN_ROUNDS = 1e-4, 4, 50
BELIEF = 0.5
#: Weight of an agreeing skip edge before any evidence, and its bounds after.
SKIP_PRIOR, SKIP_BOUNDS = 5.5, (3.0, 8.0)

#: The base patterns. Matches start where a run of digits starts, as leftmost matches do anyway.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Weaker candidates.
NUMBERS = re.compile(r"(?<![0-9A-Za-z])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}(?![0-9A-Za-z])")
AT = re.compile(r"\[at\]|\(at\)|\{at\}")
DOT = re.compile(r"\[dot\]|\(dot\)|\{dot\}")
SPELLED = re.compile(
    rf"(?<![\w.])[A-Za-z0-9][A-Za-z0-9._%+-]{{0,63}}\s?(?:{AT.pattern})\s?[A-Za-z0-9-]{{1,63}}"
    rf"(?:\s?(?:{DOT.pattern}|\.)\s?[A-Za-z0-9-]{{1,63}}){{1,6}}"
)
#: Words before a candidate that tell its kind.
CUES = (
    frozenset("mail email e-mail contact correo courriel".split()),
    frozenset("ip host server address addr".split()),
    frozenset("card visa mastercard credit karte carte tarjeta".split()),
    frozenset("phone tel call fax mobile telefon telefono telephone".split()),
)
_DIGITS = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the sure spans, by kind, then start."""
    out, at, done = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((0, start, found.end()))
        done = found.end() if found else at + 1
        at = text.find("@", done)
    if not _DIGITS.search(text):
        return out
    out += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def mentions(text: str) -> list[tuple[int, int, int]]:
    """Nodes of the graph: (label or NONE, start, end) by start; NONE for candidates."""
    sure = base_spans(text)
    taken = sorted((s, e) for _, s, e in sure)
    weak, i = [], 0
    found = [m.span() for p in (NUMBERS, SPELLED) if _DIGITS.search(text) or p is SPELLED for m in p.finditer(text)]
    for start, end in sorted(found):
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if (i == len(taken) or taken[i][0] >= end) and (not weak or weak[-1][2] <= start):
            weak.append((NONE, start, end))
    return sorted(sure + weak, key=lambda m: (m[1], m[2], m[0]))


def features(text: str, start: int, end: int) -> list[float]:
    said, digits = text[start:end], _digits(text[start:end])
    n = len(digits)
    before = [w.strip(".,:;()=").lower() for w in text[max(0, start - 40) : start].split()[-3:]]
    return [
        1.0,
        float(said.startswith("+")),
        float("(" in said),
        float("@" in said or AT.search(said) is not None),
        float(said.count(".") == 3 and n <= 12),
        float(bool(n) and luhn(digits)),
        *[float(low <= n < high) for low, high in ((0, 1), (1, 7), (7, 10), (10, 12), (12, 16), (16, 20), (20, 10**9))],
        float(" " in said),
        float("-" in said),
        float(any(c.isalpha() for c in said)),
        *[float(any(w in cues for w in before)) for cues in CUES],
    ]


def skip_edges(text: str, nodes: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Each node and the previous one with the same content or the same last seven digits; each candidate and the
    first sure span with that key."""
    seen: dict[str, int] = {}
    sure: dict[str, int] = {}
    weak: list[tuple[str, int]] = []
    out = set()
    for i, (label, start, end) in enumerate(nodes):
        said, digits = text[start:end], _digits(text[start:end])
        keys = {"=" + DOT.sub(".", AT.sub("@", re.sub(r"\s", "", said.lower())))}
        if len(digits) >= 7 and not any(c.isalpha() for c in said):
            keys.add("#" + digits[-7:])
        for key in keys:
            if key in seen:
                out.add((seen[key], i))
            seen[key] = i
            if label == NONE:
                weak.append((key, i))
            else:
                sure.setdefault(key, i)
    out.update((min(i, sure[key]), max(i, sure[key])) for key, i in weak if key in sure)
    return sorted(out)


class SkipChain:
    """Weights of nodes (features x labels), chain edges (label x label) and skip edges (agreement)."""

    def __init__(self, node: np.ndarray, chain: np.ndarray, skip: float):
        self.node, self.chain, self.skip = node, chain, skip

    def beliefs(self, text: str, nodes: list[tuple[int, int, int]]) -> np.ndarray:
        """Label probabilities per node by loopy message passing."""
        labels, n = NONE + 1, len(nodes)
        unary = np.array([features(text, s, e) for _, s, e in nodes]) @ self.node
        for i, (label, _, _) in enumerate(nodes):
            if label != NONE:
                unary[i] = -np.inf  # however many candidates are joined to it
                unary[i, label] = 0.0
        chain = [(i, i + 1) for i in range(n - 1)]
        skips = skip_edges(text, nodes)
        edges = np.array(chain + skips, np.int64).reshape(-1, 2)
        pair = np.array([self.chain] * len(chain) + [self.skip * np.eye(labels)] * len(skips)).reshape(-1, labels, labels)
        source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
        reverse = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        messages = np.zeros((len(source), labels))
        for _ in range(MIN_ROUNDS + ROUNDS_PER_NODE * n):
            total = unary.copy()
            np.add.at(total, target, messages)
            out = total[source] - messages[reverse]
            new = np.logaddexp.reduce(out[:, :, None] + pair, axis=1)
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - messages).max(initial=0.0)
            messages = 0.5 * messages + 0.5 * new
            if change <= TOLERANCE:
                break
        total = unary.copy()
        np.add.at(total, target, messages)
        total = np.exp(total - total.max(axis=1, keepdims=True))
        return total / total.sum(axis=1, keepdims=True)

    def spans(self, text: str) -> tuple[list, list]:
        """Base spans and all spans of a text, each by kind and start."""
        nodes = mentions(text)
        sure = [m for m in nodes if m[0] != NONE]
        added = []
        if sure and len(sure) < len(nodes) or any(m[0] == NONE for m in nodes):
            belief = self.beliefs(text, nodes)
            best = belief.argmax(axis=1)
            added = [
                (int(best[i]), s, e)
                for i, (label, s, e) in enumerate(nodes)
                if label == NONE and best[i] != NONE and belief[i, best[i]] >= BELIEF
            ]
        return sorted(sure), sorted(sure + added)


def fit(labels: np.ndarray, rows: np.ndarray, pairs: np.ndarray, follows: np.ndarray) -> SkipChain:
    """Logistic regression for the nodes; smoothed log odds for the edges. pairs, follows: label x label counts."""
    classes, width = NONE + 1, len(features("", 0, 0))
    weights = np.zeros((width, classes))
    weights[0, NONE] = 1.0  # without evidence a candidate is nothing
    if len(labels):
        share = np.bincount(labels, minlength=classes) / len(labels)
        importance = 1.0 / np.maximum(share[labels], 0.05)
        importance /= importance.sum()
        for _ in range(300):
            score = rows @ weights
            p = np.exp(score - score.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(labels)), labels] -= 1
            weights -= 1.0 * (rows.T @ (p * importance[:, None]) + 0.005 * weights)
    same = np.trace(pairs)
    other = pairs.sum() - same
    skip = float(np.clip(SKIP_PRIOR + np.log((same + 1) / (other + 1)) / 2, *SKIP_BOUNDS))
    counts = 1 + follows
    expected = np.outer(counts.sum(axis=1), counts.sum(axis=0)) / counts.sum()
    return SkipChain(weights, np.clip(np.log(counts / expected), -1, 1), skip)


def train(docs: DataFrame) -> SkipChain:
    """Node weights from a sample per label, edge weights from the counts of all documents."""
    texts = docs.select(F.xxhash64("doc_id", "text").alias("h"), "text").where(F.col("text").rlike("[0-9@]|[\\[({]at[\\])}]"))
    width, classes = len(features("", 0, 0)), NONE + 1
    per_label = TRAIN_MENTIONS // classes
    names = ["what", "a", "b", "n", "hash", "features"]
    schema = "what string, a int, b int, n long, hash long, features array<double>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        lowest: list[list] = [[] for _ in range(classes)]  # heaps of (-hash, features)
        for batch in batches:
            for h, text in zip(batch["h"], batch["text"]):
                nodes = mentions(text)
                linked, open_ = [[] for _ in nodes], [False] * len(nodes)
                for a, b in skip_edges(text, nodes):
                    linked[b].append(nodes[a][0])
                    for x, y in ((a, b), (b, a)):  # a candidate like a sure span may well be one
                        open_[x] |= nodes[x][0] == NONE != nodes[y][0]
                for i, (label, s, e) in enumerate(nodes):
                    if open_[i]:
                        continue
                    if i and not open_[i - 1]:
                        counts["chain", nodes[i - 1][0], label] += 1
                    for a in linked[i]:
                        if NONE not in (a, label):  # candidates have no sure label
                            counts["skip", a, label] += 1
                    order, heap = (1 << 63) - 1 - xxhash.xxh64_intdigest(f"{h}|{i}"), lowest[label]
                    if len(heap) < per_label:
                        heapq.heappush(heap, (order, features(text, s, e)))
                    elif order > heap[0][0]:
                        heapq.heapreplace(heap, (order, features(text, s, e)))
        rows = [(what, a, b, n, None, None) for (what, a, b), n in counts.items()]
        rows += [("node", label, -1, 1, -order - 1, x) for label, heap in enumerate(lowest) for order, x in heap]
        yield pd.DataFrame(rows, columns=names).astype({"hash": "Int64"})

    found = written(texts.mapInPandas(run, schema), "training")  # a bounded number of rows a task
    edges = {"skip": np.zeros((classes, classes)), "chain": np.zeros((classes, classes))}
    for r in found.where("what <> 'node'").groupBy("what", "a", "b").agg(F.sum("n").alias("n")).collect():
        edges[r.what][r.a, r.b] = r.n
    sample = []
    for label in range(classes):
        sample += found.where((F.col("what") == "node") & (F.col("a") == label)).orderBy("hash", "features").limit(per_label).collect()
    return fit(
        np.array([r.a for r in sample], np.int64),
        np.array([r.features for r in sample]).reshape(-1, width),
        edges["skip"],
        edges["chain"],
    )


def written_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find_spans(docs: DataFrame, model: SkipChain) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the base spans), spans (all) per row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sure, spans = model.spans(text)
                count = [sum(k == kind for k, _, _ in sure) for kind in range(len(KINDS))]
                out.append((doc_id, *count, hashlib.sha256(written_spans(sure).encode()).hexdigest(), written_spans(spans)))
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return texts.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with [KIND] in place of its spans; of overlapping ones the first, reaching over all."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda m: (m[1], m[0])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_documents(docs: DataFrame, model: SkipChain) -> DataFrame:
    """``docs`` with masked texts; n_chars follows them."""

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else masked(t, model.spans(t)[1]))

    out = docs.withColumn("text", cleaned("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
