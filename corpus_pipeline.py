"""A training corpus from ``documents``, in five stages.

Every stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all rows that
the stage before it kept; all but the last return the columns of documents.
``run`` writes what a stage returns as Parquet into the shared folder and reads
it for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from prismark.llm import exact_dedup, jaccard_join, language_id, pii
from prismark.llm.packing import pack
from prismark.llm.runtime import free_shuffles, read_table, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language: without letters, pages of signs, noise, languages that are not learned."""
    return language_id.keep_identified(docs, language_id.fit(docs), max_unlikely=1.4, min_letters=0.1)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the longest original, then the smallest id."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that links by 5-word shingles at a Jaccard similarity of 0.8 or more."""
    return jaccard_join.keep_one_of_each_group(docs, n=5, p=80, q=100, lean=True)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; ``n_chars`` follows the new text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences of at most 1024 tokens."""
    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), window=1024, end_id=0)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL cannot express the stages; tests/llm holds them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        free_shuffles(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
