"""Corpus pipeline: from raw documents to packed token windows.

Five stages, each an operator of ``ratewise.llm``, in this order: documents of
no recognised language go, then toxic ones, then all but one of each group of
near-duplicates; secrets in the rest are replaced, and what is left is packed.
Each stage reads what the one before wrote.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ratewise.llm import language, ngram_join, packing, secrets, toxicity
from ratewise.llm.common import held_out, stored, table

#: A text needs this share of n-grams of one language; mixed texts of two languages stay above it.
LEAST_LANGUAGE_SCORE = 0.3
VOCABULARY = "word_bpe_49k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs, language.fit(docs.where(~held_out())), LEAST_LANGUAGE_SCORE)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, toxicity.fit(docs.where(~held_out()), table(spark, sf_dir, "labels")))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language", identify_language),
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack_windows),
]

#: Learned models and tokenizers are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
