"""Query of the language identification; held-out accuracy is tested instead of check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from delinq.llm.byte_cnn import predict, train
from delinq.llm.common import table
from delinq.llm.registry import register


@register("op9_byte_cnn")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    held_out = F.coalesce(part == 2, F.lit(False))
    found = predict(docs, train(docs, part != 2))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
