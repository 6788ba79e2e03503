"""A training corpus from ``documents``: good, distinct, without repeats and secrets, packed.

Each stage takes all that the one before it kept, written as Parquet and read back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.llm import neardup, packing, quality_model, secrets, substrings
from touchline.llm.common import as_table, documents, importable, labels, small_batches
from touchline.llm.queries import BYTE_VOCABULARY, QUALITY_FROM, quality_network


def _sized(docs: DataFrame) -> DataFrame:
    """Bring ``n_chars`` up to date after a change of ``text``."""
    return docs.select(*(F.length("text").cast("bigint").alias(c) if c == "n_chars" else c for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects."""
    importable(small_batches(spark))
    return quality_model.keep_good(docs, quality_network(docs, labels(spark, sf_dir)), QUALITY_FROM)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    small_batches(spark)
    return neardup.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every passage that stands anywhere else too."""
    small_batches(spark)
    return _sized(substrings.remove_repeats(docs))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mark."""
    return _sized(secrets.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of one length."""
    small_batches(spark)
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path(BYTE_VOCABULARY), with_ids=False))


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("substring dedup", repeats),
    ("secret scans", redact),
    ("best-fit packing", pack),
]

# The classifier and the tokenizer are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = as_table(docs, "pipeline")
    return docs
