"""Query of the personal data search; tests hold its base spans against plain patterns."""

from __future__ import annotations

from delinq.llm.common import table
from delinq.llm.registry import register
from delinq.llm.skip_crf import find_spans, train


@register("op10_skip_crf")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_spans(docs, train(docs))
