"""Query of the mix; its draws have no SQL form, tests hold it against its sources' targets."""

from __future__ import annotations

from delinq.llm.common import table
from delinq.llm.pivotal_mix import mix
from delinq.llm.registry import register


@register("op5_pivotal_mix")
def op5(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
