"""One registered query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelforge.llm import (
    decontaminate, exact_dedup, interval_repair, language_id, license_scan, page_text, prefix_trie, repeat_removal,
    sentencepiece_codec, simhash_near, token_files, toxicity, window_removal,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(folder).rstrip('/')}/{name}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Every paragraph of every document that states a licence."""

    return license_scan.find_licenses(_table(spark, folder, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every (document, benchmark item) pair with a passage of the item in the document."""

    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score and significant passages of every document."""

    return toxicity.toxic_documents(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document and whether decoding them gives the text back."""

    return sentencepiece_codec.token_ids(_table(spark, folder, "documents"))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal documents by block naming; the largest doc_id of each stays."""

    return exact_dedup.exact_groups(_table(spark, folder, "documents")).drop("row")


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that occur elsewhere too."""

    return repeat_removal.remove_repeats(_table(spark, folder, "documents"))


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""

    return page_text.extract_text(_table(spark, folder, "pages"))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language and score of every document."""

    return language_id.identify(_table(spark, folder, "documents"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token count of every document, from flat token files."""

    return token_files.document_token_counts(_table(spark, folder, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash fingerprint and component of every document."""

    return simhash_near.simhash_groups(_table(spark, folder, "documents")).drop("row", "kept")


def op11_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""

    return prefix_trie.conversation_trie(_table(spark, folder, "conversations"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, least cost, audit and repaired hash of every damaged conversation."""

    return interval_repair.damaged_and_repaired(_table(spark, folder, "conversations"))


def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the words of 35-word windows that occur elsewhere too."""

    return window_removal.remove_repeated_windows(_table(spark, folder, "documents"))


OP5_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP13_SQL = """
WITH words AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
    SELECT r, i, list_slice(w, i, i + 34) AS said FROM words, unnest(range(1, greatest(len(w) - 33, 1))) AS t(i)
), repeated AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY said) AS n FROM windows) WHERE n > 1
), removed AS (
    SELECT DISTINCT r, i + k AS i FROM repeated, unnest(range(0, 35)) AS t(k)
), split AS (
    SELECT r, i, w[i] AS word FROM words, unnest(range(1, len(w) + 1)) AS t(i)
), per_text AS (
    SELECT split.r, count(removed.r) AS n_removed, string_agg(word, ' ' ORDER BY split.i) FILTER (removed.r IS NULL) AS kept
    FROM split LEFT JOIN removed ON removed.r = split.r AND removed.i = split.i GROUP BY split.r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN per_text USING (r)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_html_extraction": op7_html_extraction,
    "op8_language_id": op8_language_id,
    "op9_token_counts": op9_token_counts,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_conversation_prefix_trie": op11_conversation_prefix_trie,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_substring_dedup": op13_substring_dedup,
}
SQL = {"op5_exact_dedup": OP5_SQL, "op13_substring_dedup": OP13_SQL}
