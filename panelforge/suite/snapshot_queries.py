"""Snapshot comparison between documents and an altered copy of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators import snapshots as S
from panelforge.sources.tables import sample_rows
from panelforge.suite.common import Suite, Tables, number

suite = Suite()
COLUMNS = ("doc_id", "lang", "source", "n_chars", "text")


def local(t: Tables) -> DataFrame:
    return t("documents").select(*COLUMNS)


def live(t: Tables, unique: bool = False) -> DataFrame:
    """Some documents dropped, changed, added and (unless ``unique``) doubled."""

    k = F.col("doc_id") % 50
    docs = local(t)
    kept = docs.where(k != 7).withColumn("lang", F.when(k == 11, "xx").otherwise(F.col("lang")))
    doubled = docs.where(k == 17)
    added = docs.where(k == 13).withColumn("doc_id", F.col("doc_id") + 1000000000)
    grown = kept.unionByName(added)
    return grown if unique else grown.unionByName(doubled)


DIFF_SQL = """
SELECT 'local_only' AS side, 1::BIGINT AS copies, doc_id, lang, source, n_chars, md5(text) AS text_md5
FROM documents WHERE doc_id % 50 IN (7, 11)
UNION ALL
SELECT 'live_only', 1, doc_id, 'xx', source, n_chars, md5(text) FROM documents WHERE doc_id % 50 = 11
UNION ALL
SELECT 'live_only', 1, doc_id, lang, source, n_chars, md5(text) FROM documents WHERE doc_id % 50 = 17
UNION ALL
SELECT 'live_only', 1, doc_id + 1000000000, lang, source, n_chars, md5(text) FROM documents WHERE doc_id % 50 = 13"""


@suite.register(DIFF_SQL)
def snapshot_diff(t: Tables) -> DataFrame:
    # The altered copy differs in three of the ten classes of ids.
    found = S.snapshot_diff(local(t), live(t), [F.pmod("doc_id", F.lit(10))])
    return found.select("side", "copies", "doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))


@suite.register("""
SELECT DISTINCT doc_id % 10 AS class, source FROM documents WHERE doc_id % 50 IN (7, 11, 17)
UNION SELECT (doc_id + 1000000000) % 10, source FROM documents WHERE doc_id % 50 = 13""")
def differing_ranges(t: Tables) -> DataFrame:
    """The (id class, source) ranges in which the altered copy differs."""

    ranges = [F.pmod("doc_id", F.lit(10)), F.col("source")]
    return S.differing_ranges(local(t), live(t), ranges).toDF("class", "source")


SAMPLE_SQL = """
sampled AS (
  SELECT *, md5(CAST(doc_id AS VARCHAR)) AS key_hash,
         row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS position
  FROM documents
), sample AS (SELECT * FROM sampled WHERE position <= 25)"""


def sampled(t: Tables) -> DataFrame:
    return S.sample_positions(local(t), "source", ["doc_id"])


@suite.register(f"WITH {SAMPLE_SQL} SELECT source, CAST(position AS BIGINT) AS position, doc_id, key_hash FROM sample")
def sample_positions(t: Tables) -> DataFrame:
    return sampled(t).select("source", number("position").alias("position"), "doc_id", "key_hash")


OUTCOME_SQL = "CASE WHEN doc_id % 50 = 7 THEN 'absent' WHEN doc_id % 50 = 11 THEN 'changed' ELSE 'match' END"


def compared(t: Tables) -> DataFrame:
    return S.compare_by_key(sampled(t), live(t, unique=True), ["doc_id"], ["lang", "source", "n_chars", "text"])


@suite.register(f"""WITH {SAMPLE_SQL}
SELECT doc_id, source, {OUTCOME_SQL} AS outcome, CASE WHEN doc_id % 50 = 11 THEN 'lang' ELSE '' END AS changed_columns
FROM sample""")
def sample_key_compare(t: Tables) -> DataFrame:
    return compared(t).select("doc_id", "source", "outcome", "changed_columns")


@suite.register(f"""WITH {SAMPLE_SQL}, l AS (SELECT source AS table_name, count(*) AS local_rows FROM documents GROUP BY 1),
v AS (
  SELECT source AS table_name, CAST(sum(CASE WHEN doc_id % 50 = 7 THEN 0 WHEN doc_id % 50 IN (13, 17) THEN 2 ELSE 1 END) AS BIGINT) AS live_rows
  FROM documents GROUP BY 1
), s AS (
  SELECT source AS table_name, count(*) FILTER (WHERE {OUTCOME_SQL} = 'match') AS sample_matches,
         count(*) FILTER (WHERE {OUTCOME_SQL} <> 'match') AS sample_issues FROM sample GROUP BY 1
)
SELECT table_name, local_rows, live_rows, sample_matches, sample_issues, live_rows - local_rows AS difference,
  CASE WHEN sample_issues > 0 OR live_rows < local_rows THEN 'DRIFT_REVIEW'
       WHEN live_rows > local_rows THEN 'GOOD_OLDER_SNAPSHOT' ELSE 'GOOD_MATCH' END AS status
FROM l LEFT JOIN v USING (table_name) LEFT JOIN s USING (table_name)""")
def drift_report(t: Tables) -> DataFrame:
    def per_source(df: DataFrame) -> DataFrame:
        return df.groupBy(F.col("source").alias("table_name")).agg(F.count(F.lit(1)).alias("row_count"))

    return S.drift_report(
        per_source(local(t)), per_source(live(t)), compared(t).withColumn("table_name", F.col("source"))
    )


FIELD_SQL = " || '|' || ".join(
    f"length(CAST({c} AS VARCHAR)) || ':' || {c}" for c in ("doc_id", "lang", "source", "n_chars", "text")
)

FINGERPRINT_SQL = " || ':' || ".join(
    f"CAST(coalesce(sum(CAST('0x' || substr(h, {1 + 8 * i}, 8) AS BIGINT)), 0) AS VARCHAR)" for i in range(4)
)


@suite.register(f"""
WITH s AS (
  SELECT *, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS position FROM documents)
SELECT 'documents' AS table_name, (SELECT count(*) FROM documents) AS row_count,
  sha256('doc_id:bigint,lang:string,source:string,n_chars:bigint,text:string') AS schema_fingerprint,
  (SELECT {FINGERPRINT_SQL} FROM (SELECT md5({FIELD_SQL}) AS h FROM documents)) AS rows_fingerprint,
  string_agg(sha256({FIELD_SQL}), ',' ORDER BY position) AS sample_row_hashes
FROM s WHERE position <= 25""")
def manifest(t: Tables) -> DataFrame:
    return S.manifest(local(t), "documents", ["doc_id"], "2026-01-01 00:00:00").drop("written_at")


@suite.register("SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10")
def sample_limit(t: Tables) -> DataFrame:
    return sample_rows(t("customer").select("c_custkey", "c_name"), 10, ["c_custkey"])
