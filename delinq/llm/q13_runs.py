"""Query of the periodic runs: a tenth of the documents get a periodic end; tests hold it against brute force."""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from delinq.llm.common import table
from delinq.llm.periodic_runs import analyse
from delinq.llm.registry import register


def with_periodic_end(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Fixed rule of the query: where crc32(doc_id) % 10 is 0, the words from place a on repeat with a period."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * ((n - a) // p + 1))[: n - a]


@register("op13_periodic_runs")
def op13(spark, sf_dir):
    found = analyse(table(spark, sf_dir, "documents"), with_periodic_end)
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("l"), r.start.alias("s"), r.period.alias("q"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.q").alias("period"),
        F.expr("1000 * -best.l div best.q").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
