"""What the text operators share: the word rule, table access and safe column names."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delinq.session import scratch_path

#: Fixed value: white space between words, as a character class body.
BLANK = r"\x20\x09-\x0D"
WORD = f"[^{BLANK}]+"
#: Fixed value: bytes.translate table for A-Z to a-z only.
LOWER_AZ = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back: lineage ends there and survives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder with its scheme, as Spark's file system resolves it, for tasks that write files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, name))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def packed(docs: DataFrame) -> Column:
    """All columns of a table as one struct, so that own columns beside it never clash with given ones."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def let(value: Column, body) -> Column:
    """body(value) with value computed once per row, also where body uses it inside a lambda."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def words_of(text: Column) -> Column:
    """Words of a text as an array; null gives an empty one. Plain replacements are faster than a pattern."""
    flat = F.coalesce(text, F.lit(""))
    for blank in "\t\n\x0b\x0c\r":
        flat = F.replace(flat, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(flat, " "), "")


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def by_bytes(batch: pa.RecordBatch, column: int, rows: int = 256, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most so many rows, and bytes in a text column (or one row)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for at, size in enumerate(sizes):
        if at > start and (at - start == rows or held + size > limit):
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


class Memory:
    """Values by text key in two generations: what is not asked for while about ``size`` new keys come in is forgotten.

    Keys count by their length, as many of usual length as ``size`` says, so a generation is bounded in bytes. A worker
    process holds one memory at a time: the others are emptied when another is asked.
    """

    #: Characters of a usual key with what its entry takes besides.
    USUAL = 40
    last: Memory | None = None

    def __init__(self, size: int):
        self.size = size
        self.forget()

    def forget(self) -> None:
        self.now: dict = {}
        self.before: dict = {}
        self.held = 0

    def missing(self, keys: set) -> list:
        """Keys without a value yet; the others are in ``now`` until the next call."""
        if Memory.last is not self:
            if Memory.last is not None:
                Memory.last.forget()
            Memory.last = self
        if self.held > self.size * self.USUAL:
            self.before, self.now, self.held = self.now, {}, 0
        out, before, now, kept = [], self.before, self.now, 0
        for key in keys:
            if key in now:
                continue
            value = before.get(key)
            if value is None:
                out.append(key)
            else:
                now[key] = value
                kept += 30 + len(key)
        self.held += kept + 30 * len(out) + sum(map(len, out))
        return out
