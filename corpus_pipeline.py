"""Corpus preparation: the stages, in order, each over all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelforge.llm import decontaminate, exact_dedup, language_id, sentencepiece_codec, simhash_near
from panelforge.session import land


def keep_known_languages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep documents with a letter whose language the network tells with some confidence."""

    return language_id.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep, of equal texts, the row with the largest doc_id."""

    return exact_dedup.keep_one_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep, of texts linked by SimHash fingerprints within two bits on three-word shingles, the row with the smallest doc_id."""

    return simhash_near.keep_one_per_component(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop documents that hold a passage of a benchmark item."""

    benchmark = spark.read.parquet(f"{str(folder).rstrip('/')}/benchmark.parquet")
    return decontaminate.keep_clean(docs, benchmark)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Add token ids, their number and the result of decoding them."""

    return sentencepiece_codec.encode_texts(docs)


STAGES = [
    ("language id", keep_known_languages),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("sentencepiece encoding", encode),
]

# Trained models, SimHash and tokenization cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is stored and read again."""

    docs = spark.read.parquet(f"{str(folder).rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, folder), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, folder)
