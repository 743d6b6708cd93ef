"""Language identification by a convolutional network over bytes.

Bytes are embedded, filters of several widths slide over fixed-length windows, the largest answer of each filter
goes into a softmax. The network is trained in numpy on windows of labelled documents: about ``PER_LANG`` windows a
language, chosen by hashes of doc_id at hashed places, at most ``MAX_WINDOWS`` in all. It is applied to all windows
of every text; a text's probabilities are the means over its windows, weighed by their bytes.

Defined results: ``und`` with score 0 for texts that are null or have no letter, and for all texts if there is
nothing to learn from; rows without doc_id are predicted, not learned from; repeated rows are predicted one by one;
an empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delinq.llm.common import written

UNDETERMINED = "und"
PER_LANG = 250
MAX_WINDOWS = 20_000
#: Languages whose counts go into the plan; with more of them they are joined.
PLANNED = 1000
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 10
EPOCHS = 8
BATCH = 32
RATE = 0.01
#: Windows answered at once.
APPLY = 256


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text, the last one filled with zeros."""
    n = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


class ByteNetwork:
    def __init__(self, langs: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.p = {"embed": rng.normal(0, 0.3, (256, EMBED)).astype(np.float32)}
        for k in WIDTHS:
            self.p[f"w{k}"] = rng.normal(0, (k * EMBED) ** -0.5, (k * EMBED, FILTERS)).astype(np.float32)
            self.p[f"b{k}"] = np.zeros(FILTERS, np.float32)
        self.p["out"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(langs))).astype(np.float32)
        self.p["bias"] = np.zeros(len(langs), np.float32)

    def _pooled(self, windows: np.ndarray, width: int) -> np.ndarray:
        """(windows, places, filters): one table look-up per byte of a filter instead of products."""
        places, weights = WINDOW - width + 1, self.p[f"w{width}"].reshape(width, EMBED, FILTERS)
        answer = np.broadcast_to(self.p[f"b{width}"], (len(windows), places, FILTERS)).copy()
        for j in range(width):
            answer += (self.p["embed"] @ weights[j])[windows[:, j : j + places]]
        return answer

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        pooled = np.concatenate([np.maximum(self._pooled(windows, k).max(axis=1), 0) for k in WIDTHS], axis=1)
        return _softmax(pooled @ self.p["out"] + self.p["bias"])

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        n, pooled, where = len(windows), [], []
        for k in WIDTHS:
            answer = self._pooled(windows, k)
            where.append(answer.argmax(axis=1))
            pooled.append(answer.max(axis=1))
        features = np.concatenate(pooled, axis=1)
        active = np.maximum(features, 0)
        error = _softmax(active @ self.p["out"] + self.p["bias"])
        error[np.arange(n), labels] -= 1
        error /= n
        g = {"out": active.T @ error, "bias": error.sum(axis=0), "embed": np.zeros_like(self.p["embed"])}
        back = (error @ self.p["out"].T) * (features > 0)
        for i, k in enumerate(WIDTHS):
            d = back[:, i * FILTERS : (i + 1) * FILTERS]
            seen = windows[np.arange(n)[:, None, None], where[i][:, :, None] + np.arange(k)]  # bytes of the largest answer
            patches = self.p["embed"][seen].reshape(n, FILTERS, k * EMBED)
            g[f"w{k}"] = np.einsum("nfe,nf->ef", patches, d)
            g[f"b{k}"] = d.sum(axis=0)
            np.add.at(g["embed"], seen, (d[:, :, None] * self.p[f"w{k}"].T[None]).reshape(n, FILTERS, k, EMBED))
        return g

    def fit(self, windows: np.ndarray, labels: np.ndarray, seed: int = 2) -> ByteNetwork:
        """Adam over shuffled batches."""
        rng, step = np.random.default_rng(seed), 0
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        for _ in range(EPOCHS):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), BATCH):
                some, step = order[at : at + BATCH], step + 1
                for k, g in self.gradients(windows[some], labels[some]).items():
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.999 * square[k] + 0.001 * g * g
                    rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.p[k] = (self.p[k] - rate * mean[k] / (np.sqrt(square[k]) + 1e-8)).astype(np.float32)
        return self

    def predict(self, texts: list[bytes]) -> list[tuple[str, float]]:
        cut = [windows_of(t) for t in texts]
        found, all_windows = [], np.concatenate(cut) if cut else np.empty((0, WINDOW), np.uint8)
        for at in range(0, len(all_windows), APPLY):
            found.append(self.probabilities(all_windows[at : at + APPLY]))
        found, at, out = np.concatenate(found) if found else np.empty((0, len(self.langs))), 0, []
        for text, windows in zip(texts, cut):
            n = len(windows)
            sizes = np.full(n, float(WINDOW))
            sizes[-1] = max(1, len(text) - (n - 1) * WINDOW)
            mean = sizes @ found[at : at + n] / sizes.sum()
            at += n
            best = int(mean.argmax())
            out.append((self.langs[best], float(min(max(mean[best], 0.0), 1.0))))
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(docs: DataFrame, usable: Column) -> ByteNetwork | None:
    """A network for the languages of the usable rows (``lang`` and text not null); None without any.

    A document's hash times the documents of its language is about its rank there. Those of rank up to ``PER_LANG`` are
    taken, the lowest ranks of all languages first, so a small language stays whole beside large ones. Windows are cut
    before anything is shuffled.
    """
    labelled = docs.where(usable & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = written(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    h = F.xxhash64("doc_id")
    room = F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
    window = F.substring("text", F.pmod(F.hash(h), room) + 1, F.lit(WINDOW))
    share = F.shiftrightunsigned(h, 11).cast("double") / float(1 << 53)  # in [0, 1)
    rows = labelled.select("lang", h.alias("h"), share.alias("share"), window.alias("window"))
    few = counts.limit(PLANNED + 1).collect()
    if len(few) <= PLANNED:
        sizes = F.create_map(*[F.lit(x) for r in few for x in (r.lang, r.n)]) if few else F.create_map().cast("map<string,bigint>")
        rows = rows.withColumn("n", sizes[F.col("lang")])
    else:
        rows = rows.join(counts, "lang")
    ranked = rows.withColumn("rank", F.col("share") * F.col("n")).where(F.col("rank") < PER_LANG)
    picked = ranked.orderBy("rank", "h", "lang", "window").select("lang", "window").limit(MAX_WINDOWS)
    sample = picked.collect()  # at most MAX_WINDOWS windows of WINDOW characters
    if not sample:
        return None
    langs = sorted({r.lang for r in sample})
    windows = np.concatenate([windows_of(r.window.encode())[:1] for r in sample])
    return ByteNetwork(langs).fit(windows, np.array([langs.index(r.lang) for r in sample]))


def predict(docs: DataFrame, network: ByteNetwork | None) -> DataFrame:
    """doc_id, lang_pred, score."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                some = batch.slice(at, 128)
                data = [None if t is None else t.encode() for t in some.column(1).to_pylist()]
                known = [t for t in data if t is not None] if network is not None else []
                answers = iter(network.predict(known)) if known else iter(())
                found = [(UNDETERMINED, 0.0) if t is None or network is None else next(answers) for t in data]
                langs, scores = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], schema=schema
                )

    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")
