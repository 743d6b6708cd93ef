"""Query of the piece encoding; tests hold it against a whole-text search and the library's own."""

from __future__ import annotations

import public_tokenizers

from delinq.llm.common import table
from delinq.llm.piece_viterbi import round_trip
from delinq.llm.registry import register


@register("op3_piece_viterbi")
def op3(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
