"""From raw documents to token ids, in stages that are each written and read again.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept and, but for the
last, returns the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, langid, pieces, pii, simhash
from millrace.llm.common import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in none of the languages the model knows go: a score under 0.3, NULL texts and texts without a letter."""
    return langid.keep_identified(docs, langid.LanguageModel(langid.learnable(docs)))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, that of the least id."""
    return simhash.keep_one_per_group(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the text."""
    return pii.mask_personal_data(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` of what is left."""
    return pieces.encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

# The language model and the fingerprints are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
