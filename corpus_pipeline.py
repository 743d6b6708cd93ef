"""Corpus pipeline: quality rules, near duplicates, personal data, mixture, piece ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet to the shared folder and
read again as the next one's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from delinq.llm import jaccard_groups, piece_viterbi, pivotal_mix, quality_lines, skip_crf
from delinq.llm.common import table, written

MODEL = "piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without lines that are frequent in their source."""
    return quality_lines.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_groups.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return skip_crf.mask_documents(docs, skip_crf.train(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return pivotal_mix.mix_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, n_ids, ids, round_trip of every row."""
    return piece_viterbi.round_trip(docs, public_tokenizers.path(MODEL))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("pieces", pieces),
]

#: The mixture's draws and the piece search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
