"""Query of the token files, read back; an exact round trip in the tests stands for check SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from delinq.llm.common import table
from delinq.llm.registry import register
from delinq.llm.token_blocks import read_tokens, write_tokens


@register("op4_token_blocks")
def op4(spark, sf_dir):
    manifest, folder = write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(manifest, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
