"""Catalog operators on a catalog derived from parts: a brand is a library, a part a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators import catalog as K
from panelforge.operators import conform as C
from panelforge.functions.numbers import pretty_bytes
from panelforge.suite.common import Suite, Tables, number

suite = Suite()

TABLE_SQL = "replace(p_name, ' ', '_') || '_' || p_partkey"
TYPES = (
    "smallint", "integer", "bigint", "double precision", "numeric(12,2)", "numeric(50,4)", "numeric",
    "character varying(20)", "text[]", "timestamp without time zone", "timestamp with time zone",
    "time without time zone", "Boolean", "bytea", "real[][]", "interval",
)
SPARK_TYPES = (
    "smallint", "int", "bigint", "double", "decimal(12,2)", "string", "string", "string", "array<string>",
    "timestamp_ntz", "timestamp", "bigint", "boolean", "binary", "array<array<float>>", "string",
)


def table_name() -> Column:
    return F.concat_ws("_", F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.col("p_partkey"))


def classes(t: Tables) -> DataFrame:
    size = F.col("p_size")
    return t("part").select(
        F.col("p_brand").alias("library"),
        table_name().alias("table_name"),
        F.when(size % 10 == 0, "v").otherwise("r").alias("kind"),
        F.when(size % 7 == 0, F.lit(-1)).otherwise(size * 1000).cast("bigint").alias("reltuples"),
        F.floor(F.col("p_retailprice") * size * size * size).cast("bigint").alias("total_bytes"),
        F.when(size % 3 == 0, "  ").when(size % 3 == 2, F.concat(F.lit(" "), "p_type", F.lit(" "))).alias("comment"),
    )


def attributes(t: Tables) -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey")
    numbers = F.concat(F.array(F.lit(-1)), F.sequence(F.lit(1), size % 6 + 1))
    types = F.array(*[F.lit(x) for x in TYPES])
    rows = t("part").select("p_brand", "p_partkey", table_name().alias("table_name"), F.explode(numbers).alias("attnum"))
    attnum = F.col("attnum")
    return rows.select(
        F.col("p_brand").alias("library"),
        "table_name",
        attnum.cast("int").alias("attnum"),
        F.concat(F.lit("c"), attnum.cast("string")).alias("column_name"),
        F.get(types, (key + F.abs(attnum)) % len(TYPES)).alias("data_type"),
        ((key + attnum) % 11 == 0).alias("dropped"),
        (attnum == 1).alias("not_null"),
        F.when(attnum == 2, F.lit("second")).alias("comment"),
    )


def constraints(t: Tables) -> DataFrame:
    size = F.col("p_size")
    return t("part").where(size % 4 != 0).select(
        F.col("p_brand").alias("library"),
        table_name().alias("table_name"),
        F.when(size % 4 == 3, "u").otherwise("p").alias("contype"),
        F.when(size % 6 >= 1, F.array(F.lit(2), F.lit(1))).otherwise(F.array(F.lit(1))).alias("conkey"),
    )


def defaults(t: Tables) -> DataFrame:
    return t("part").where(F.col("p_partkey") % 5 == 0).select(
        F.col("p_brand").alias("library"), table_name().alias("table_name"), F.lit(1).alias("attnum"),
        F.lit("nextval()").alias("column_default"),
    )


def libraries(t: Tables) -> DataFrame:
    """All brands but one, plus one library without tables."""

    brands = t("part").select(F.col("p_brand").alias("library")).where(F.col("p_brand") != "Brand#7")
    return brands.unionByName(t("region").select(F.concat(F.lit("Brand#empty"), "r_regionkey").alias("library"))).distinct()


CATALOG_SQL = f"""
classes AS (
  SELECT p_brand AS library, {TABLE_SQL} AS table_name, p_partkey, p_size,
         CASE WHEN p_size % 10 = 0 THEN 'v' ELSE 'r' END AS kind,
         CASE WHEN p_size % 7 = 0 THEN 0 ELSE p_size * 1000 END AS estimated_rows,
         CAST(floor(p_retailprice * p_size * p_size * p_size) AS BIGINT) AS total_table_bytes,
         CASE WHEN p_size % 3 = 0 THEN '  ' WHEN p_size % 3 = 2 THEN ' ' || p_type || ' ' END AS table_comment
  FROM part
), attributes AS (
  SELECT p_brand AS library, {TABLE_SQL} AS table_name, attnum, p_partkey, (p_partkey + attnum) % 11 = 0 AS dropped
  FROM part, LATERAL (SELECT unnest(range(1, p_size % 6 + 2)) AS attnum)
), live AS (SELECT * FROM attributes WHERE NOT dropped),
keys AS (
  SELECT p_brand AS library, {TABLE_SQL} AS table_name,
         CASE WHEN p_size % 6 >= 1 THEN 'c2, c1' ELSE 'c1' END AS primary_key_columns
  FROM part WHERE p_size % 4 IN (1, 2)
)"""


def pretty_sql(column: str) -> str:
    return (
        f"CASE WHEN {column} >= 1073741824 THEN printf('%.2f GiB', {column} / 1073741824.0::DOUBLE) "
        f"WHEN {column} >= 1048576 THEN printf('%.2f MiB', {column} / 1048576.0::DOUBLE) "
        f"WHEN {column} >= 1024 THEN printf('%.2f KiB', {column} / 1024.0::DOUBLE) ELSE {column} || ' B' END"
    )


@suite.register(f"""WITH {CATALOG_SQL}
SELECT library, count(*) AS table_count FROM classes WHERE kind = 'r' AND library <> 'Brand#7' GROUP BY 1""")
def canonical_libraries(t: Tables) -> DataFrame:
    return K.canonical_libraries(libraries(t), classes(t))


@suite.register(f"WITH {CATALOG_SQL} SELECT table_name FROM classes WHERE library = 'Brand#3' AND kind = 'r'")
def library_table_list(t: Tables) -> DataFrame:
    return K.library_tables(classes(t).where(F.col("kind") == "r"), "Brand#3")


@suite.register(f"WITH {CATALOG_SQL} SELECT * FROM keys")
def primary_key_list(t: Tables) -> DataFrame:
    return K.primary_keys(constraints(t), attributes(t))


@suite.register(f"""WITH {CATALOG_SQL}
SELECT c.library, c.table_name, CAST(estimated_rows AS BIGINT) AS estimated_rows, total_table_bytes,
  (SELECT count(*) FROM live l WHERE l.library = c.library AND l.table_name = c.table_name) AS column_count,
  primary_key_columns, table_comment, {pretty_sql('total_table_bytes')} AS size_pretty
FROM classes c LEFT JOIN keys k ON k.library = c.library AND k.table_name = c.table_name
WHERE kind = 'r' AND c.library <> 'Brand#7'""")
def table_catalog(t: Tables) -> DataFrame:
    # attnum -1 (a system column) must not be counted
    return K.table_catalog(classes(t), attributes(t), constraints(t), libraries(t))


TYPE_SQL = f"[{', '.join(chr(39) + x + chr(39) for x in TYPES)}][CAST((p_partkey + attnum) % {len(TYPES)} AS INTEGER) + 1]"
SPARK_TYPE_SQL = (
    f"[{', '.join(chr(39) + x + chr(39) for x in SPARK_TYPES)}][CAST((p_partkey + attnum) % {len(TYPES)} AS INTEGER) + 1]"
)


@suite.register(f"""WITH {CATALOG_SQL}
SELECT l.library, l.table_name, CAST(attnum AS BIGINT) AS ordinal_position, 'c' || attnum AS column_name,
  {TYPE_SQL.replace('p_partkey', 'l.p_partkey')} AS data_type,
  CASE WHEN attnum = 1 THEN 0 ELSE 1 END::BIGINT AS nullable,
  CASE WHEN attnum = 1 AND l.p_partkey % 5 = 0 THEN 'nextval()' END AS column_default,
  CASE WHEN attnum = 2 THEN 'second' END AS column_comment
FROM live l JOIN classes c ON c.library = l.library AND c.table_name = l.table_name
WHERE kind = 'r' AND l.library <> 'Brand#7'""")
def column_catalog(t: Tables) -> DataFrame:
    found = K.column_catalog(classes(t), attributes(t), defaults(t), libraries(t))
    return found.withColumn("nullable", number("nullable"))


@suite.register(f"""WITH {CATALOG_SQL}
SELECT l.library, l.table_name, count(*) AS column_count,
  string_agg('`c' || attnum || '` ' || {SPARK_TYPE_SQL.replace('p_partkey', 'l.p_partkey')} ||
             CASE WHEN attnum = 1 THEN ' NOT NULL' ELSE '' END, ', ' ORDER BY attnum) AS schema_ddl
FROM live l JOIN classes c ON c.library = l.library AND c.table_name = l.table_name
WHERE kind = 'r' AND l.library <> 'Brand#7' GROUP BY 1, 2""")
def schema_ddl_from_catalog(t: Tables) -> DataFrame:
    return C.table_schemas(K.column_catalog(classes(t), attributes(t), defaults(t), libraries(t)))


@suite.register(f"""WITH {CATALOG_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY library ORDER BY table_name) AS rn,
         row_number() OVER (PARTITION BY library, trim(coalesce(table_comment, '')) = '' ORDER BY table_name) AS crn
  FROM classes WHERE kind = 'r'
), summed AS (
  SELECT library, count(*) AS table_count, CAST(sum(estimated_rows) AS BIGINT) AS total_estimated_rows,
    CAST(sum(total_table_bytes) AS BIGINT) AS b, count(*) FILTER (WHERE trim(coalesce(table_comment, '')) <> '') AS commented_table_count,
    string_agg(table_name, ', ' ORDER BY table_name) FILTER (WHERE rn <= 5) AS sample_table_names,
    coalesce(max(trim(table_comment)) FILTER (WHERE crn = 1 AND trim(coalesce(table_comment, '')) <> ''), '') AS example_table_comment
  FROM ranked GROUP BY library
), columns_per AS (
  SELECT c.library, count(l.attnum) AS total_column_count FROM classes c
  LEFT JOIN live l ON l.library = c.library AND l.table_name = c.table_name WHERE kind = 'r' GROUP BY 1
)
SELECT library, table_count, total_estimated_rows, b AS total_table_bytes, {pretty_sql('b')} AS size_pretty,
  total_column_count, commented_table_count, sample_table_names, example_table_comment
FROM summed JOIN columns_per USING (library) WHERE library <> 'Brand#7'""")
def library_summary(t: Tables) -> DataFrame:
    tables = K.table_catalog(classes(t), attributes(t), constraints(t), libraries(t))
    return K.by_size(K.library_summary(tables))


@suite.register(f"""SELECT p_partkey, {pretty_sql('n')} AS pretty FROM (
  SELECT p_partkey, CAST(p_partkey AS BIGINT) * p_partkey * p_partkey * p_size + 128 * p_size AS n FROM part)""")
def byte_sizes(t: Tables) -> DataFrame:
    # The cube of a key outgrows a bigint beyond some hundred thousand parts.
    key, size = F.col("p_partkey").cast("decimal(20,0)"), F.col("p_size").cast("bigint")
    return t("part").select("p_partkey", pretty_bytes(key * key * key * size + size * 128).alias("pretty"))


# --- selection by configuration: brand number picks the mode of a library

def brand_number() -> Column:
    return F.regexp_extract("library", "([0-9]+)", 1).cast("int")


def selection(t: Tables):
    catalog = classes(t)
    brands = catalog.select("library").distinct().select(
        "library", brand_number().alias("library_position"), (brand_number() % 4 != 0).alias("enabled"),
        (brand_number() % 2 == 0).alias("download_all"),
    )
    part = t("part").select("*", table_name().alias("table_name"), F.col("p_brand").alias("library"))
    enabled = part.where(F.col("p_size") % 5 == 1).select("library", "table_name", F.col("p_partkey").alias("table_position"))
    disabled = part.where(F.col("p_size") % 9 == 2).select(
        "library", F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("old_"), "table_name")).otherwise(F.col("table_name"))
        .alias("table_name"),
    )
    return catalog, brands, enabled, disabled


SELECTION_SQL = f"""
config AS (
  SELECT p_brand AS library, CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS n, {TABLE_SQL} AS table_name, p_size,
         p_partkey FROM part
), disabled AS (
  SELECT library, CASE WHEN p_partkey % 2 = 0 THEN 'old_' || table_name ELSE table_name END AS table_name
  FROM config WHERE p_size % 9 = 2
)"""


@suite.register(f"""WITH {SELECTION_SQL}
SELECT library, table_name, CAST(n AS BIGINT) AS library_position,
       CASE WHEN n % 2 = 0 THEN 0 ELSE p_partkey END AS table_position
FROM config c WHERE n % 4 <> 0 AND (n % 2 = 0 OR p_size % 5 = 1)
  AND NOT EXISTS (SELECT 1 FROM disabled d WHERE d.library = c.library AND d.table_name = c.table_name)""")
def table_selection(t: Tables) -> DataFrame:
    chosen = K.select_tables(*selection(t))
    return chosen.withColumn("library_position", number("library_position"))


@suite.register(f"""WITH {SELECTION_SQL}
SELECT library, 'old_' || table_name AS table_name, 'stale disabled table' AS problem FROM config
WHERE p_size % 9 = 2 AND p_partkey % 2 = 0
UNION ALL
SELECT library, 'new_' || table_name, 'unknown enabled table' FROM config WHERE p_size % 5 = 1 AND p_partkey % 3 = 0""")
def selection_problems(t: Tables) -> DataFrame:
    catalog, _, enabled, disabled = selection(t)
    renamed = enabled.withColumn(
        "table_name",
        F.when(F.col("table_position") % 3 == 0, F.concat(F.lit("new_"), "table_name")).otherwise(F.col("table_name")),
    )
    return K.selection_problems(catalog, renamed, disabled)


@suite.register(f"""WITH {SELECTION_SQL}
SELECT library, table_name FROM config c WHERE n % 4 <> 0 AND n = 6
  AND NOT EXISTS (SELECT 1 FROM disabled d WHERE d.library = c.library AND d.table_name = c.table_name)""")
def selection_one_library(t: Tables) -> DataFrame:
    return K.selection_filter(K.select_tables(*selection(t)), library="Brand#6").select("library", "table_name")


@suite.register("""
SELECT trim(p_type) AS name, min(p_partkey) AS position FROM part GROUP BY 1""")
def distinct_names(t: Tables) -> DataFrame:
    """Names with stray blanks, blank names left out."""

    key = F.col("p_partkey")
    padded = F.when(key % 2 == 0, F.concat(F.lit("  "), "p_type")).otherwise(F.concat("p_type", F.lit(" ")))
    blanks = t("part").select(F.lit("   ").alias("p_type"), (key * 0).alias("p_partkey"))
    return K.distinct_names(t("part").select(padded.alias("p_type"), key).unionByName(blanks), "p_type", "p_partkey")


# --- lookups

LOOKUP_SQL = """
lookup AS (
  SELECT 'Brand#' || (n_nationkey % 20) AS k, n_name, n_regionkey, n_nationkey,
         row_number() OVER (PARTITION BY n_nationkey % 20 ORDER BY n_nationkey) AS rn FROM nation
)"""


def merged(t: Tables) -> DataFrame:
    base = t("part").select(
        "p_partkey", F.concat(F.lit(" "), "p_brand").alias("library"), F.lit("old").alias("description")
    )
    lookup = t("nation").select(
        F.concat(F.lit("Brand#"), F.col("n_nationkey") % 20, F.lit("  ")).alias("code"),
        F.col("n_name").alias("description"), F.col("n_regionkey").cast("bigint").alias("region"), "n_nationkey",
    )
    return K.merge_lookup(base, lookup, "library", "code", "n_nationkey", ["description", "region"])


@suite.register(f"""WITH {LOOKUP_SQL}
SELECT p_partkey, p_brand AS library, n_name AS description, CAST(n_regionkey AS BIGINT) AS region
FROM part LEFT JOIN lookup ON p_brand = k AND rn = 1""")
def lookup_merge(t: Tables) -> DataFrame:
    return merged(t)


@suite.register(f"""WITH {LOOKUP_SQL}, m AS (SELECT n_name, n_regionkey FROM part LEFT JOIN lookup ON p_brand = k AND rn = 1)
SELECT 'description' AS column_name, count(n_name) AS matched, count(*) - count(n_name) AS unmatched FROM m
UNION ALL SELECT 'region', count(n_regionkey), count(*) - count(n_regionkey) FROM m""")
def lookup_merge_counts(t: Tables) -> DataFrame:
    return K.merge_counts(merged(t), ["description", "region"])


# --- yearly families and catalog differences

FAMILY_SQL = "replace(p_name, ' ', '_') || CASE WHEN p_size % 10 = 0 THEN '' ELSE CAST(1996 + p_partkey % 30 AS VARCHAR) END"


@suite.register(f"""
SELECT regexp_replace(n, '[0-9]{{4}}$', 'YYYY') AS family, count(*) AS table_count, min(n) AS first_table, max(n) AS last_table,
  CAST(sum(r) AS BIGINT) AS "rows", CAST(sum(b) AS BIGINT) AS bytes, CAST(sum(b) AS DOUBLE) / 1073741824 AS "GiB"
FROM (SELECT {FAMILY_SQL} AS n, CAST(p_size AS BIGINT) AS r, CAST(floor(p_retailprice) AS BIGINT) * 4096 AS b FROM part)
GROUP BY 1""")
def family_rollup(t: Tables) -> DataFrame:
    year = F.when(F.col("p_size") % 10 == 0, "").otherwise((F.col("p_partkey") % 30 + 1996).cast("string"))
    tables = t("part").select(
        F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), year).alias("table_name"),
        F.col("p_size").cast("bigint").alias("estimated_rows"),
        (F.floor("p_retailprice").cast("bigint") * 4096).alias("total_table_bytes"),
    )
    return K.family_rollup(tables)


@suite.register(f"""
SELECT p_brand AS library, {TABLE_SQL} AS table_name, 'live_only' AS side FROM part WHERE p_partkey % 13 = 0
UNION ALL
SELECT p_brand, 'retired_' || {TABLE_SQL}, 'local_only' FROM part WHERE p_partkey % 17 = 0""")
def catalog_diff(t: Tables) -> DataFrame:
    live = t("part").select(F.col("p_brand").alias("library"), table_name().alias("table_name"), "p_partkey")
    kept = live.where(F.col("p_partkey") % 13 != 0).select("library", "table_name")
    retired = live.where(F.col("p_partkey") % 17 == 0).select("library", F.concat(F.lit("retired_"), "table_name").alias("table_name"))
    return K.catalog_diff(live, kept.unionByName(retired))
