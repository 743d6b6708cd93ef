"""All registered queries of the text operators."""

from __future__ import annotations

from delinq.llm.registry import CHECKS, QUERIES
from delinq.llm import q01_quality, q02_chat, q03_pieces, q04_tokens, q05_mix, q06_jaccard, q07_prints, q08_lm, q09_lang, q10_pii, q11_simhash, q12_audit, q13_runs  # noqa: F401, I001

__all__ = ["CHECKS", "QUERIES"]
