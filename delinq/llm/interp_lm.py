"""Language model scores by deleted interpolation.

p(w | h) mixes the bigram estimate c(h,w)/c(h), the unigram estimate c(w)/N and 1/(V+1). The mixture weights depend
on how often the context h was seen (buckets by powers of two) and are learned by expectation-maximisation on
held-out counts: every training token in turn is deleted from all counts and predicted from the rest. The
iterations run on a histogram of fixed size over all training tokens.

Counting and scoring meet as follows. Every task turns its documents into chunk files of at most ``CHUNK_TOKENS``
tokens in the shared folder: hashes of the chunk's words and, per token, the number of its word. Each chunk asks once
for each of its words and bigrams, with its own training counts, dealt by ranges of the 64-bit hash; a range adds up
the counts and answers every chunk in the order asked. So a frequent word costs a line per chunk, and a range holds
about as much as a chunk. Chunk files have names of their own; those in the committed table are valid.

Defined results: null text is empty, its only token is the end; rows without doc_id are scored, not learned from;
repeated rows are scored one by one (and learned from as often); without training rows every p is 1/(V+1); an empty
table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delinq.llm.common import LOWER_AZ, Memory, shared_folder, written
from delinq.llm.token_blocks import shared_store

CHUNK_TOKENS = 1_000_000
KNOWN = 200_000
#: Fixed hashes of the end token and of the context before the first token.
END, START = np.uint64(0x5E5E5E5E5E5E5E5E), np.uint64(0x57A757A757A757A7)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Histogram of the held-out counts: context buckets, steps a factor of two, lowest power of two.
BUCKETS, STEPS, LOWEST = 24, 4, -32
_BINS = -LOWEST * STEPS + 2  # one more for zero
EM_ROUNDS = 60
WORD, BIGRAM = 0, 1

_WORDS = Memory(KNOWN)


def _hashes(text: str | None) -> list[int]:
    words = (text or "").encode().translate(LOWER_AZ).split()
    for word in _WORDS.missing(set(words)):
        _WORDS.now[word] = xxhash.xxh3_64_intdigest(word)
    return [_WORDS.now[w] for w in words]


def _chunker(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = shared_store(folder)
        store.create_dir(root, recursive=True)
        part, made, docs, held, tokens = TaskContext.get().partitionId(), [], [], 0, []

        def flush():
            nonlocal docs, held, tokens
            words, index = np.unique(np.concatenate(tokens), return_inverse=True)
            sizes = np.array([len(t) for t in tokens])
            train = np.array([d[1] for d in docs])
            path, out = f"{part:06d}-{len(made):06d}-{uuid.uuid4().hex}.npz", io.BytesIO()
            np.savez_compressed(
                out, words=words, index=index.astype(np.uint16 if len(words) < 1 << 16 else np.uint32), sizes=sizes, train=train,
                ids=np.array([d[0] or 0 for d in docs], np.int64), null=np.array([d[0] is None for d in docs]),
                held=np.array([d[2] for d in docs]),
            )
            with store.open_output_stream(f"{root}/{path}") as file:
                file.write(out.getvalue())
            made.append((path, int(sizes[train].sum()), int(train.sum())))
            docs, held, tokens = [], 0, []

        for batch in batches:
            for row in batch.to_pylist():
                found = np.array([*_hashes(row["text"]), int(END)], np.uint64)
                if held and held + len(found) > CHUNK_TOKENS:
                    flush()
                docs.append((row["doc_id"], row["train"], row["held_out"]))
                tokens.append(found)
                held += len(found)
        if docs:
            flush()
        columns = list(zip(*made)) if made else [[]] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()))],
            names=["chunk", "train_tokens", "train_docs"],
        )

    return run


class Chunk:
    """A chunk file: words, tokens and bigrams of some documents."""

    def __init__(self, folder: str, name: str):
        store, root = shared_store(folder)
        with store.open_input_file(f"{root}/{name}") as file:
            data = np.load(io.BytesIO(file.read()))
            self.words, self.sizes, self.train, self.ids, self.null, self.held = (
                data[k] for k in ("words", "sizes", "train", "ids", "null", "held")
            )
            self.index = data["index"].astype(np.int64)
        self.ends = np.cumsum(self.sizes)
        self.first = self.ends - self.sizes
        self.learned = np.repeat(self.train, self.sizes)  # per token
        before = np.concatenate([[0], self.index[:-1]])
        self.before = before
        self.starts = np.zeros(len(self.index), bool)
        self.starts[self.first] = True
        context = np.where(self.starts, START, self.words[before])
        keys = (context * _MIX ^ (context >> np.uint64(29))) + self.words[self.index]
        keys = (keys ^ keys >> np.uint64(32)) * _MIX
        self.bigrams, self.bigram_index = np.unique(keys ^ keys >> np.uint64(31), return_inverse=True)

    def asked(self):
        """(kind, sorted keys, own training counts)"""
        for kind, keys, index in ((WORD, self.words, self.index), (BIGRAM, self.bigrams, self.bigram_index)):
            yield kind, keys, np.bincount(index[self.learned], minlength=len(keys)).astype("<u4")


def _bounds(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of the equal ranges of 64-bit keys begins."""
    edges = np.array([(r << 64) // ranges for r in range(1, ranges)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _asker(folder: str, ranges: int):
    schema = pa.schema(
        [("chunk", pa.string()), ("kind", pa.int32()), ("range", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
    )

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for kind, keys, counts in Chunk(folder, name).asked():
                    at = _bounds(keys, ranges)
                    some = [r for r in range(ranges) if at[r] < at[r + 1]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(some), pa.string()),
                            pa.array([kind] * len(some), pa.int32()),
                            pa.array(some, pa.int32()),
                            pa.array([keys[at[r] : at[r + 1]].tobytes() for r in some], pa.binary()),
                            pa.array([counts[at[r] : at[r + 1]].tobytes() for r in some], pa.binary()),
                        ],
                        schema=schema,
                    )

    return run, "chunk string, kind int, range int, keys binary, counts binary"


_ANSWERS = "chunk string, kind int, range int, totals binary, seen long"


def _answer(group: pa.Table) -> pa.Table:
    """Totals of one range, per chunk in the order asked; the row without chunk has the number of keys seen in training."""
    group = group.combine_chunks()
    names, asked, counts = (group.column(c).to_pylist() for c in ("chunk", "keys", "counts"))
    keys, index = np.unique(np.concatenate([np.frombuffer(k, np.uint64) for k in asked]), return_inverse=True)
    own = np.concatenate([np.frombuffer(c, "<u4") for c in counts]).astype(np.float64)
    totals = np.bincount(index, weights=own, minlength=len(keys)).astype("<i8")  # exact below 2^53
    kind = "<i4" if not len(totals) or totals.max() < 1 << 31 else "<i8"
    at, out = 0, []
    for k in asked:
        n = len(k) // 8
        out.append(totals[index[at : at + n]].astype(kind).tobytes())
        at += n
    n = len(names)
    return pa.table(
        {
            "chunk": pa.array([*names, None], pa.string()),
            "kind": pa.array([group.column("kind")[0].as_py()] * (n + 1), pa.int32()),
            "range": pa.array([group.column("range")[0].as_py()] * (n + 1), pa.int32()),
            "totals": pa.array([*out, None], pa.binary()),
            "seen": pa.array([None] * n + [int((totals > 0).sum())], pa.int64()),
        }
    )


def _counted(folder: str, ranges: int, group: pa.Table, train_docs: int):
    """The chunk of a group of answers and c(h,w), c(h), c(w) per token."""
    rows = sorted(group.select(["kind", "range", "totals"]).to_pylist(), key=lambda r: (r["kind"], r["range"]))
    chunk = Chunk(folder, group.column("chunk")[0].as_py())
    totals = []
    for kind, keys in ((WORD, chunk.words), (BIGRAM, chunk.bigrams)):
        at = _bounds(keys, ranges)
        parts = []
        for r in rows:
            if r["kind"] == kind:
                n = at[r["range"] + 1] - at[r["range"]]
                parts.append(np.frombuffer(r["totals"], "<i4" if len(r["totals"]) == 4 * n else "<i8").astype(np.float64))
        totals.append(np.concatenate(parts))
    words, bigrams = totals
    context = np.where(chunk.starts, float(train_docs), words[chunk.before])
    return chunk, bigrams[chunk.bigram_index], context, words[chunk.index]


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else one more than the power of two below their count."""
    return np.where(context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)


def _bin(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.clip(np.rint((np.log2(np.maximum(p, 1e-300)) - LOWEST) * STEPS), 0, _BINS - 2).astype(np.int64) + 1, 0)


def _bin_value() -> np.ndarray:
    return np.concatenate([[0.0], 2.0 ** (LOWEST + np.arange(_BINS - 1) / STEPS)])


def _ratio(a, b):
    return np.divide(a, b, out=np.zeros_like(a), where=b > 0)


def fit_weights(histogram: dict[int, int], vocabulary: int) -> np.ndarray:
    """(bucket, 3): weights of the bigram, unigram and even estimates, by expectation-maximisation."""
    counts = np.zeros(BUCKETS * _BINS * _BINS)
    for k, n in histogram.items():
        counts[k] = n
    counts = counts.reshape(BUCKETS, _BINS, _BINS)
    value, even = _bin_value(), 1.0 / (vocabulary + 1)
    weights = np.tile([0.4, 0.5, 0.1], (BUCKETS, 1))
    if not histogram:
        return np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    for b in range(BUCKETS):
        seen = counts[b] if counts[b].any() else counts.sum(axis=0)  # buckets without evidence take the common weights
        two, one = np.broadcast_arrays(value[:, None], value[None, :])
        w = weights[b] if b else np.array([0.0, 0.8, 0.2])
        for _ in range(EM_ROUNDS):
            parts = np.stack([w[0] * two, w[1] * one, np.full_like(two, w[2] * even)])
            share = (seen * parts / parts.sum(axis=0)).sum(axis=(1, 2))
            w = np.maximum(share / share.sum(), [0.0, 0.0, 1e-6])
            w = w / w.sum()
        weights[b] = w
    return weights


def score(docs: DataFrame, train: Column, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learns from the rows of ``train``."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "chunks")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.coalesce(train, F.lit(False)).alias("train"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    chunks = written(rows.mapInArrow(_chunker(folder), "chunk string, train_tokens long, train_docs long"), "chunks")
    n_chunks, tokens, train_docs = chunks.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("train_tokens"), F.lit(0)), F.coalesce(F.sum("train_docs"), F.lit(0))
    ).first()
    ranges = max(1, n_chunks)
    ask, kind = _asker(folder, ranges)
    asked = chunks.select("chunk").repartition(ranges, "chunk").mapInArrow(ask, kind)
    answers = written(asked.groupBy("kind", "range").applyInArrow(_answer, _ANSWERS), "answers")
    seen = answers.where(F.col("chunk").isNull() & (F.col("kind") == WORD))
    vocabulary = seen.agg(F.coalesce(F.sum("seen"), F.lit(0))).first()[0]
    grouped = answers.where("chunk is not null").select("chunk", "kind", "range", "totals").groupBy("chunk")

    def held_out_counts(group: pa.Table) -> pa.Table:
        chunk, two, context, one = _counted(folder, ranges, group, train_docs)
        two, context, one = (x[chunk.learned] - 1 for x in (two, context, one))  # without the token itself
        place = (_bucket(context) * _BINS + _bin(_ratio(two, context))) * _BINS + _bin(one / max(tokens - 1, 1))
        bins, n = np.unique(place, return_counts=True)
        return pa.table({"bin": pa.array(bins, pa.int32()), "n": pa.array(n, pa.int64())})

    bins = grouped.applyInArrow(held_out_counts, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    weights = fit_weights({r["bin"]: r["n"] for r in bins.collect()}, vocabulary)  # a bounded number of bins

    def scores(group: pa.Table) -> pa.Table:
        chunk, two, context, one = _counted(folder, ranges, group, train_docs)
        w = weights[_bucket(context)]
        p = w[:, 0] * _ratio(two, context) + w[:, 1] * one / max(tokens, 1) + w[:, 2] / (vocabulary + 1)
        base = np.log10((one + 0.5) / (tokens + 0.5 * (vocabulary + 1)))
        add = lambda x: np.add.reduceat(x, chunk.first)  # noqa: E731  every document has its end token
        return pa.table(
            {
                "doc_id": pa.array(chunk.ids, pa.int64(), mask=chunk.null),
                "held_out": pa.array(chunk.held, pa.bool_()),
                "n_tokens": pa.array(chunk.sizes, pa.int64()),
                "n_known": pa.array(add((one > 0).astype(np.int64)), pa.int64()),
                "train_tokens": pa.array(np.full(len(chunk.ids), tokens), pa.int64()),
                "base_score": pa.array(add(base), pa.float64()),
                "score": pa.array(add(np.log10(p)), pa.float64()),
            }
        )

    return grouped.applyInArrow(
        scores, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
