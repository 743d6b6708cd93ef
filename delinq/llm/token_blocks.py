"""Token ids in binary shards of patched frame-of-reference blocks.

A shard is one file. All numbers are little-endian:

    header   8 bytes magic, then unsigned 32-bit: block length, number of blocks, documents; 64-bit: ids
    blocks   one after the other
    index    per block its start in the file, 64-bit
    rows     per document: doc_id (64-bit), ids (32-bit)

    block    minimum (32), width (8), exceptions (16), ids in the block (32), then the ids less the minimum,
             their low ``width`` bits packed, then per exception its position (16) and its high bits (32)

The width is the smallest that holds ``percentile`` percent of a block's values; the others are exceptions.

Documents are dealt into ranges of doc_id; every task encodes its range in order and writes shards of at most
``SHARD_IDS`` ids (a longer document has a shard of its own) to the shared folder, under names of their own, so
a task that runs twice leaves a stray file but never a half one. The rows that Spark commits name the valid
shards. The start of a range is the sum of the ranges before it, one number a range. Ranges are cut by doc_id and a
hash of the text, so rows without doc_id or with one repeated doc_id are dealt out like others.

Defined results: null text is empty and has only the end id; rows without doc_id come first; equal doc_ids stand
in the order of a hash of their texts; strings of special tokens inside a text get their id, as the library gives it; an
empty table gives no shard; a text of any length is encoded whole, in one task. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delinq.llm.common import Memory, shared_folder, written

MAGIC = b"IDBLOCK1"
BLOCK = 4096
PERCENTILE = 95.0
SHARD_IDS = 2_000_000
END_ID = 0
MAX_READERS = 10_000
#: Entries of the encoder's memory, per Python worker.
KNOWN = 400_000

_HEADER = np.dtype([("magic", "S8"), ("block", "<u4"), ("blocks", "<u4"), ("docs", "<u4"), ("ids", "<u8")])
_BLOCK = np.dtype([("low", "<u4"), ("width", "u1"), ("exceptions", "<u2"), ("n", "<u4")])
_ROW = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<u4")])
_SHARDS = pa.schema(
    [
        ("part", pa.int32()),
        ("shard", pa.int32()),
        ("path", pa.string()),
        ("start_in_part", pa.int64()),
        ("n_ids", pa.int64()),
        ("n_docs", pa.int64()),
    ]
)
_MANIFEST = "part int, shard int, path string, start_in_part long, n_ids long, n_docs long"


def pack_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    low = int(ids.min())
    rest = (ids - np.uint32(low)).astype(np.uint32)
    kept = np.sort(rest)[max(0, int(np.ceil(len(rest) * percentile / 100.0)) - 1)]
    width = int(kept).bit_length()
    out = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    bits = (rest[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    head = np.array([(low, width, len(out), len(ids))], _BLOCK).tobytes()
    high = (rest[out] >> np.uint32(width)).astype("<u4") if len(out) else np.empty(0, "<u4")
    return head + np.packbits(bits.astype(np.uint8), bitorder="little").tobytes() + out.astype("<u2").tobytes() + high.tobytes()


def unpack_block(data: bytes, at: int) -> np.ndarray:
    low, width, exceptions, n = np.frombuffer(data, _BLOCK, 1, at)[0].tolist()
    at += _BLOCK.itemsize
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width, bitorder="little").reshape(n, width)
    rest = np.zeros(n, np.uint32)
    for k in range(width):
        rest |= bits[:, k].astype(np.uint32) << np.uint32(k)
    at += size
    if exceptions:
        where = np.frombuffer(data, "<u2", exceptions, at)
        rest[where] |= np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions) << np.uint32(width)
    return rest + np.uint32(low)


def pack_shard(doc_ids: list, counts: list[int], ids: np.ndarray) -> bytes:
    blocks = [pack_block(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    head = np.array([(MAGIC, BLOCK, len(blocks), len(counts), len(ids))], _HEADER).tobytes()
    starts = len(head) + np.cumsum([0, *map(len, blocks)][: len(blocks)], dtype="<u8")
    rows = np.array([(d or 0, d is None, n) for d, n in zip(doc_ids, counts)], _ROW)
    return b"".join([head, *blocks, np.asarray(starts, "<u8").tobytes(), rows.tobytes()])


def unpack_shard(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """doc_ids (None where null), ids per document, all ids."""
    magic, _, blocks, docs, n_ids = np.frombuffer(data, _HEADER, 1)[0].tolist()
    if magic != MAGIC:
        raise ValueError("not a token shard")
    rows_at = len(data) - docs * _ROW.itemsize
    starts = np.frombuffer(data, "<u8", blocks, rows_at - 8 * blocks)
    ids = np.concatenate([unpack_block(data, int(s)) for s in starts]) if blocks else np.empty(0, np.uint32)
    if len(ids) != n_ids:
        raise ValueError("a token shard is cut")
    rows = np.frombuffer(data, _ROW, docs, rows_at)
    return [None if r["null"] else int(r["doc_id"]) for r in rows], rows["n"].astype(np.int64), ids


class Encoder:
    """Byte-level BPE of whole texts by the tokenizers library, which is asked once per word.

    The vocabulary's own splitting never joins a character that isn't white space with a blank behind it, and
    gives a single blank to the letter, number or sign behind it. So a text cut before such blanks has the
    ids of its parts, one after the other, and equal parts have equal ids. For the same reason new parts are
    encoded many at a time as one text; the bytes of each id tell where a part ends.

    Parts are remembered without their blank; the first of a text, which has none, gets one as a mark.

    A text that holds a string the vocabulary treats as special (the library gives it one id, wherever it stands) is
    encoded as a whole.
    """

    CUT = re.compile(r"(?<=\S) (?=\S)")
    JOINED = 64

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)  # a character stands for a byte
        self.known = Memory(KNOWN)

    def _parts(self, text: str) -> list[str]:
        words = text.split(" ")
        if "" in words or [w.strip() for w in words] != words:  # other white space beside a blank
            words = self.CUT.split(text)
        words[0] = " " + words[0]
        return words

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", f.ids).tobytes() for f in found]

    def _ids_of_words(self, words: list[str]) -> list[bytes]:
        """Ids of parts that neither begin nor end with white space, each with a blank before it."""
        texts = [" " + " ".join(words[i : i + self.JOINED]) for i in range(0, len(words), self.JOINED)]
        data = b"".join(self._ids(texts))
        ends = np.cumsum(self.n_bytes[np.frombuffer(data, "<u4")])
        wanted = np.cumsum([1 + len(w.encode()) for w in words])
        at = np.searchsorted(ends, wanted)
        if len(ends) != at[-1] + 1 or not np.array_equal(ends[at], wanted):
            return self._ids([" " + w for w in words])
        stops = (4 * (at + 1)).tolist()
        return [data[a:b] for a, b in zip([0, *stops], stops)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        whole = [i for i, text in enumerate(texts) if any(s in text for s in self.special)]
        parts = [self._parts(text) for text in texts]
        for i in whole:
            parts[i] = []
        new = self.known.missing(set().union(*parts))
        known = self.known.now
        words = [w for w in new if w == w.strip()]
        alone = [w for w in new if w != w.strip()]
        for i in range(0, len(words), 4096):
            some = words[i : i + 4096]
            known.update(zip(some, self._ids_of_words(some)))
        for i in range(0, len(alone), 4096):
            some = alone[i : i + 4096]
            known.update(zip(some, self._ids([w[1:] if w[0] == " " else " " + w for w in some])))
        out = [np.frombuffer(b"".join([known[w] for w in p]), "<u4") for p in parts]
        for i in whole:
            out[i] = np.frombuffer(self._ids([texts[i]])[0], "<u4")
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per vocabulary and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def shared_store(folder: str):
    """File system and path of a qualified folder (``shared_folder``), whatever store holds it."""
    if "://" not in folder:
        return fs.LocalFileSystem(), folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def _writer(vocabulary: str, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = shared_store(folder)
        store.create_dir(root, recursive=True)
        part, made, start = TaskContext.get().partitionId(), [], 0
        doc_ids, counts, pieces, held = [], [], [], 0

        def flush():
            nonlocal doc_ids, counts, pieces, held, start
            path = f"{root}/{part:06d}-{len(made):06d}-{uuid.uuid4().hex}.ids"
            with store.open_output_stream(path) as out:
                out.write(pack_shard(doc_ids, counts, np.concatenate(pieces)))
            made.append((part, len(made), path.removeprefix(root + "/"), start, held, len(counts)))
            start += held
            doc_ids, counts, pieces, held = [], [], [], 0

        end = np.array([END_ID], "<u4")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256).to_pydict()
                for doc_id, ids in zip(rows["doc_id"], encoder(vocabulary).encode(rows["text"])):
                    if held and held + len(ids) + 1 > SHARD_IDS:
                        flush()
                    doc_ids.append(doc_id)
                    counts.append(len(ids) + 1)
                    pieces += [ids, end]
                    held += len(ids) + 1
        if counts:
            flush()
        columns = zip(*made) if made else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SHARDS)], schema=_SHARDS)

    return run


def write_tokens(docs: DataFrame, vocabulary: str) -> tuple[DataFrame, str]:
    """Write all texts; returns the manifest (a row a shard, with its start) and the folder of the shards."""
    folder = shared_folder(docs.sparkSession, "tokens")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = texts.withColumn("h", F.xxhash64("text"))
    dealt = keyed.repartitionByRange(F.asc_nulls_first("doc_id"), "h").sortWithinPartitions(F.asc_nulls_first("doc_id"), "h", "text")
    shards = written(dealt.select("doc_id", "text").mapInArrow(_writer(vocabulary, folder), _MANIFEST), "shards")
    per_part = shards.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))  # a row a range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("part_start"))
    manifest = shards.join(starts, "part").withColumn("start", F.col("part_start") + F.col("start_in_part"))
    return manifest.drop("part_start", "start_in_part"), folder


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = shared_store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{root}/{row['path']}") as file:
                    doc_ids, counts, ids = unpack_shard(file.read())
                ends = np.cumsum(counts)
                data = ids.astype("<u4").tobytes()
                out = {
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "start": pa.array(row["start"] + ends - counts, pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids": pa.array([data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), counts.tolist())], pa.binary()),
                }
                yield pa.RecordBatch.from_pydict(out)

    return run


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit) of every document in the shards."""
    tasks = min(max(manifest.count(), 1), MAX_READERS)
    some = manifest.select("path", "start").repartition(tasks, "path")  # a few bytes stand for a whole file
    return some.mapInArrow(_reader(folder), "doc_id long, start long, n_tokens long, ids binary")
