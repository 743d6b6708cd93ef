"""Query of the language model scores; tests hold it against a plain model of the same form."""

from __future__ import annotations

from pyspark.sql import functions as F

from delinq.llm.common import table
from delinq.llm.interp_lm import score
from delinq.llm.registry import register


@register("op8_interp_lm")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return score(docs, part != 1, part == 1)
