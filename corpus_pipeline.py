"""The corpus pipeline: stages over documents, each written and read again by the caller.

Defined cases: a null or empty text fails the quality rules; rows without an id, and rows that share one, are rows of their own, and of equal or
near-equal texts one row stays, whether it has an id or not; null languages and sources are a cell and a queue of their own; empty tables give no pieces;
other columns, whatever their names, are kept up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from textmill.llm import near_dup, packing, quality, secret_scan
from textmill.llm.common import table, written


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a quality rule, or are outliers of their language and source, go."""
    return quality.keep(docs)


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dup.one_of_each(docs)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; every document stays, and n_chars follows its text."""
    return secret_scan.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES = [("quality_rules", good), ("near_dup", different), ("secret_scan", no_secrets), ("packing", packed)]
#: Several stages have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
