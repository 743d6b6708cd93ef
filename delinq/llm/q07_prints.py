"""Query of the fingerprints; tests hold it against texts put together in Python."""

from __future__ import annotations

from delinq.llm.common import table
from delinq.llm.prefix_hash import with_next
from delinq.llm.registry import register


@register("op7_prefix_hash")
def op7(spark, sf_dir):
    return with_next(table(spark, sf_dir, "documents"))
