"""Query of the SimHash near duplicates; tests hold it against all pairs."""

from __future__ import annotations

from delinq.llm.common import table
from delinq.llm.registry import register
from delinq.llm.simhash_bytes import near_duplicates


@register("op11_simhash_bytes")
def op11(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
