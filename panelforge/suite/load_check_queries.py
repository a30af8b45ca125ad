"""Normalization and post-load checks on an option panel built from line items.

Security = part, contract = order key, date = ship date. Bad values are planted
by key arithmetic; every row of the table takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.operators import conform as C
from panelforge.operators.checklist import post_load_checklist as post_load
from panelforge.operators import normalize as N
from panelforge.operators import quality as Q
from panelforge.functions.numbers import quantize_half_even
from panelforge.plans.contracts import RULES
from panelforge.plans.load_plan import union_years
from panelforge.suite.common import Suite, Tables, iso

suite = Suite()


def every(n: int) -> Column:
    return F.col("l_orderkey") % n == 0


def planted(value: Column, bad, n: int) -> Column:
    """``value``, or ``bad`` on every n-th order.

    An array lookup instead of CASE: the checks of a dozen columns meet in one
    filter, and the optimizer would multiply out nested CASE branches there.
    """

    return F.get(F.array(value, F.lit(bad)), every(n).cast("int"))


# --- raw option rows as they come from a source: loose types, planted errors

def raw_options(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    line = F.col("l_linenumber")
    return (t("lineitem") if lines is None else lines).select(
        "l_orderkey",
        "l_linenumber",
        planted(planted(F.col("l_partkey").cast("double"), -1.0, 101), float("nan"), 97).alias("secid"),
        planted(planted(iso(day), None, 107), "not-a-date", 103).alias("date"),
        F.concat(F.lit("S"), F.col("l_partkey"), F.lit("."), F.col("l_suppkey")).alias("symbol"),
        planted((line % 2).cast("string"), "2", 109).alias("symbol_flag"),
        iso(F.date_add(day, 30)).alias("exdate"),
        F.lit(None).cast("string").alias("last_date"),
        planted(
            F.get(F.array(F.translate("l_linestatus", "OF", "CP"), F.lit(None)), (line == 5).cast("int")), "X", 113
        ).alias("cp_flag"),
        F.col("l_extendedprice").alias("strike_price"),
        F.col("l_quantity").alias("best_bid"),
        (F.col("l_quantity") + 0.5).alias("best_offer"),
        (F.col("l_quantity") + planted(F.lit(0.0), 0.5, 127)).alias("volume"),
        (line * 10).cast("bigint").alias("open_interest"),
        planted(F.col("l_discount") / 3, float("nan"), 131).alias("impl_volatility"),
        F.col("l_tax").alias("delta"),
        planted(F.col("l_discount") / 7, 2147.483648, 137).alias("gamma"),
        (F.col("l_extendedprice") * 100).alias("vega"),
        (F.col("l_extendedprice") / -3).alias("theta"),
        F.col("l_orderkey").alias("optionid"),
        F.lit(1.0).alias("cfadj"),
        planted(line % 2, 2, 139).alias("am_settlement"),
        F.get(F.array(F.lit(100.0), F.lit(-99.0)), (line == 1).cast("int")).alias("contract_size"),
        F.translate("l_returnflag", "ANR", "E01").alias("ss_flag"),
        F.when(line == 3, F.lit("w")).alias("expiry_indicator"),
    )


BAD = {
    "secid": (
        "l_orderkey % 97 <> 0 AND l_orderkey % 101 = 0",
        "must contain whole non-negative values no greater than 4294967295",
    ),
    "date": ("l_orderkey % 103 = 0", "must contain dates"),
    "symbol_flag": ("l_orderkey % 109 = 0", "contains unexpected values; allowed: 0, 1"),
    "cp_flag": ("l_orderkey % 113 = 0", "contains unexpected values; allowed: C, P"),
    "volume": ("l_orderkey % 127 = 0", "must contain whole non-negative values no greater than 4294967295"),
    "gamma": ("l_orderkey % 137 = 0", "must fit six decimals between -2147.483648 and 2147.483647"),
    "am_settlement": ("l_orderkey % 139 = 0", "must contain only documented 0/1 flag values"),
}
ANY_BAD = " OR ".join(f"({test})" for test, _ in BAD.values())


def half_even_sql(expression: str) -> str:
    return f"round_even(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,18)), 6)"


@suite.register(f"""
SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_partkey END AS secid,
  CASE WHEN l_orderkey % 107 = 0 THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date,
  'S' || l_partkey || '.' || l_suppkey AS symbol, CAST(l_linenumber % 2 AS VARCHAR) AS symbol_flag,
  strftime(l_shipdate + INTERVAL 30 DAY, '%Y-%m-%d') AS exdate, CAST(NULL AS VARCHAR) AS last_date,
  CASE WHEN l_linenumber = 5 THEN NULL WHEN l_linestatus = 'O' THEN 'C' ELSE 'P' END AS cp_flag,
  CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS strike_price,
  l_quantity AS best_bid, l_quantity + 0.5 AS best_offer, CAST(l_quantity AS BIGINT) AS volume,
  CAST(l_linenumber * 10 AS BIGINT) AS open_interest,
  CASE WHEN l_orderkey % 131 = 0 THEN NULL ELSE CAST({half_even_sql('l_discount / 3')} AS DOUBLE) END AS impl_volatility,
  CAST({half_even_sql('l_tax')} AS DOUBLE) AS delta, CAST({half_even_sql('l_discount / 7')} AS DOUBLE) AS gamma,
  CAST({half_even_sql('l_extendedprice * 100')} AS DOUBLE) AS vega,
  CAST({half_even_sql('l_extendedprice / -3')} AS DOUBLE) AS theta,
  l_orderkey AS optionid, CAST(1 AS DOUBLE) AS cfadj, CAST(l_linenumber % 2 AS BIGINT) AS am_settlement,
  CAST(CASE WHEN l_linenumber = 1 THEN -99 ELSE 100 END AS BIGINT) AS contract_size,
  CASE l_returnflag WHEN 'A' THEN 'E' WHEN 'N' THEN '0' ELSE '1' END AS ss_flag,
  CASE WHEN l_linenumber = 3 THEN 'w' END AS expiry_indicator
FROM lineitem WHERE NOT ({ANY_BAD})""")
def norm_valid(t: Tables) -> DataFrame:
    valid = N.valid_rows(N.normalize_family(raw_options(t), "opprcd"))
    kinds = {"float": "double", "decimal": "double", "short": "bigint", "integer": "bigint"}
    columns = []
    for f in valid.schema:
        kind = f.dataType.typeName()
        if f.name == "optionid":
            columns.append(F.col(f.name).cast("bigint").alias(f.name))
        elif kind == "date":
            columns.append(iso(f.name).alias(f.name))
        else:
            columns.append(F.col(f.name).cast(kinds[kind]).alias(f.name) if kind in kinds else F.col(f.name))
    return valid.select(*columns)


@suite.register(
    "\nUNION ALL\n".join(
        f"SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, '{name}' AS column_name, "
        f"'{problem}' AS problem FROM lineitem WHERE {test}"
        for name, (test, problem) in BAD.items()
    )
)
def norm_violations(t: Tables) -> DataFrame:
    found = N.violation_rows(N.normalize(raw_options(t), RULES["opprcd"]), ["l_orderkey", "l_linenumber"])
    return found.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
                        "column_name", "problem")


@suite.register(f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CAST({half_even_sql('CAST(l_orderkey * 10 + 5 AS DOUBLE) / 1e7')} AS DOUBLE) AS tie,
  CAST({half_even_sql('-CAST(l_orderkey * 10 + 5 AS DOUBLE) / 1e7')} AS DOUBLE) AS negative_tie,
  CAST({half_even_sql('l_extendedprice / 7')} AS DOUBLE) AS price
FROM lineitem""")
def norm_fixed_point(t: Tables) -> DataFrame:
    tie = (F.col("l_orderkey") * 10 + 5).cast("double") / F.lit(1e7)
    return t("lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        quantize_half_even(tie, "double").cast("double").alias("tie"),
        quantize_half_even(-tie, "double").cast("double").alias("negative_tie"),
        quantize_half_even(F.col("l_extendedprice") / 7, "double").cast("double").alias("price"),
    )


# --- clean panel rows for the post-load checks

def option_panel(t: Tables) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    return t("lineitem").select(
        F.when(~((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R")), F.col("l_partkey")).alias("secid"),
        F.when(~((F.col("l_linenumber") == 2) & (F.col("l_returnflag") == "A")), day).alias("date"),
        F.col("l_orderkey").alias("optionid"),
        F.date_add(day, 30).alias("exdate"),
        F.when(F.col("l_linestatus") == "O", "C").when(F.col("l_linenumber") != 4, "P").alias("cp_flag"),
        F.floor(F.col("l_extendedprice") / 1000).cast("double").alias("strike_price"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        (F.col("l_linenumber") * 10).cast("bigint").alias("open_interest"),
        F.year(day).alias("source_year"),
    )


PANEL_SQL = """
panel AS (
  SELECT CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN NULL ELSE l_partkey END AS secid,
         CASE WHEN l_linenumber = 2 AND l_returnflag = 'A' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS date,
         l_orderkey AS optionid, CAST(l_shipdate AS DATE) + 30 AS exdate,
         CASE WHEN l_linestatus = 'O' THEN 'C' WHEN l_linenumber <> 4 THEN 'P' END AS cp_flag,
         floor(l_extendedprice / 1000) AS strike_price, CAST(l_quantity AS BIGINT) AS volume,
         CAST(l_linenumber * 10 AS BIGINT) AS open_interest, year(l_shipdate) AS source_year
  FROM lineitem
)"""

YEAR_LIST = list(range(1994, 2004))

YEARLY_SQL = f"""
SELECT CAST(y AS INTEGER) AS source_year, count(source_year) AS row_count,
       coalesce(CAST(min(date) AS VARCHAR), '') AS min_date, coalesce(CAST(max(date) AS VARCHAR), '') AS max_date
FROM range({YEAR_LIST[0]}, {YEAR_LIST[-1] + 1}) r(y) LEFT JOIN panel ON source_year = y GROUP BY y"""


@suite.register(f"WITH {PANEL_SQL} {YEARLY_SQL}")
def yearly_summary_zero_filled(t: Tables) -> DataFrame:
    return Q.yearly_summary(option_panel(t), "source_year", "date", YEAR_LIST)


@suite.register(
    f"WITH {PANEL_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{k}' AS key_column, count(*) FILTER (WHERE {k} IS NULL) AS null_rows FROM panel"
        for k in ("secid", "date", "optionid", "exdate", "cp_flag", "strike_price")
    )
)
def key_null_counts(t: Tables) -> DataFrame:
    return Q.key_null_counts(option_panel(t), Q.REQUIRED_KEYS["opprcd"])


@suite.register("""
SELECT count(*) AS duplicate_groups FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""")
def duplicate_key_groups(t: Tables) -> DataFrame:
    return Q.duplicate_key_groups(t("lineitem"), ["l_orderkey", "l_linenumber"])


# --- identifier links: one per customer and year, some incomplete

def links(t: Tables) -> DataFrame:
    """Date-ranged links secid (customer) to permno, at most one per year of a secid."""

    day = F.col("o_orderdate").cast("date")
    yearly = t("orders").groupBy(F.col("o_custkey").alias("secid"), F.year(day).alias("y")).agg(
        F.min(day).alias("sdate"), F.max(day).alias("edate"), F.min("o_orderkey").alias("first_order")
    )
    k = F.col("first_order")
    return yearly.select(
        "secid",
        F.when(k % 23 != 0, F.col("sdate")).alias("sdate"),
        F.when(k % 29 != 0, F.col("edate")).alias("edate"),
        F.when(k % 19 != 0, k + 10000).alias("permno"),
        F.when(k % 31 != 0, (k % 3 + 1).cast("double")).alias("score"),
    )


LINKS_SQL = """
links AS (
  SELECT secid, CASE WHEN k % 23 <> 0 THEN sd END AS sdate, CASE WHEN k % 29 <> 0 THEN ed END AS edate,
         CASE WHEN k % 19 <> 0 THEN k + 10000 END AS permno,
         CASE WHEN k % 31 <> 0 THEN CAST(k % 3 + 1 AS DOUBLE) END AS score
  FROM (SELECT o_custkey AS secid, min(CAST(o_orderdate AS DATE)) AS sd, max(CAST(o_orderdate AS DATE)) AS ed,
               min(o_orderkey) AS k FROM orders GROUP BY o_custkey, year(o_orderdate))
)"""

LINK_QUALITY_SQL = """
SELECT count(*) AS row_count, count(*) FILTER (WHERE permno IS NULL) AS missing_permno,
  count(*) FILTER (WHERE sdate IS NULL) AS missing_sdate, count(*) FILTER (WHERE edate IS NULL) AS missing_edate,
  count(*) FILTER (WHERE score = 1) AS score_1_rows,
  count(*) FILTER (WHERE score <> 1 OR score IS NULL) AS non_score_1_rows
FROM links"""


@suite.register(f"WITH {LINKS_SQL} {LINK_QUALITY_SQL}")
def link_quality(t: Tables) -> DataFrame:
    return Q.link_quality(links(t))


def _measure(table: str, check: str, value: str, source: str) -> str:
    return f"SELECT '{table}' AS \"table\", '{check}' AS check_name, CAST({value} AS VARCHAR) AS value FROM {source}"


REPORT_SQL = " UNION ALL ".join(
    [
        _measure("opprcd1995", "row_count", "count(*)", "panel"),
        _measure("opprcd1995", "min_date", "min(date)", "panel"),
        _measure("opprcd1995", "max_date", "max(date)", "panel"),
        *[
            _measure("opprcd1995", f"null_{k}", f"count(*) FILTER (WHERE {k} IS NULL)", "panel")
            for k in ("secid", "date", "optionid", "exdate", "cp_flag", "strike_price")
        ],
        _measure(
            "opprcd1995", "duplicate_contract_date_keys", "count(*)",
            "(SELECT 1 FROM panel GROUP BY secid, date, optionid, exdate, cp_flag, strike_price HAVING count(*) > 1)",
        ),
        _measure("secprd", "row_count", "count(*)", "panel"),
        _measure("secprd", "null_secid", "count(*) FILTER (WHERE secid IS NULL)", "panel"),
        _measure("secprd", "null_date", "count(*) FILTER (WHERE date IS NULL)", "panel"),
        *[
            f"SELECT 'secprd', 'source_year_' || source_year || '_{m}', CAST({m} AS VARCHAR) FROM yearly"
            for m in ("row_count", "min_date", "max_date")
        ],
        _measure("opcrsphist", "row_count", "count(*)", "links"),
        *[
            _measure("opcrsphist", f"null_{k}", f"count(*) FILTER (WHERE {k} IS NULL)", "links")
            for k in ("permno", "sdate", "edate")
        ],
        *[
            f"SELECT 'opcrsphist', '{name}', CAST({column} AS VARCHAR) FROM quality"
            for name, column in (
                ("link_quality_row_count", "row_count"), ("missing_permno", "missing_permno"),
                ("missing_sdate", "missing_sdate"), ("missing_edate", "missing_edate"),
                ("score_1_rows", "score_1_rows"), ("non_score_1_rows", "non_score_1_rows"),
            )
        ],
        _measure("securd", "row_count", "count(*)", "supplier"),
        _measure("securd", "null_secid", "count(*) FILTER (WHERE s_suppkey IS NULL)", "supplier"),
        "SELECT 'exchgd', 'missing_or_unreadable', 'exchgd is not known'",
    ]
)


@suite.register(
    f"WITH {PANEL_SQL}, {LINKS_SQL}, yearly AS ({YEARLY_SQL}), quality AS ({LINK_QUALITY_SQL}) {REPORT_SQL}"
)
def validation_report(t: Tables) -> DataFrame:
    panel = option_panel(t)
    targets = [
        ("opprcd1995", "opprcd", []),
        *[("secprd", "secprd", [y]) for y in YEAR_LIST],
        ("opcrsphist", "opcrsphist", []),
        ("securd", "securd", []),
        ("exchgd", "exchgd", []),
    ]
    tables = {
        "opprcd1995": panel,
        "secprd": panel,
        "opcrsphist": links(t),
        "securd": t("supplier").select(F.col("s_suppkey").alias("secid")),
    }
    return Q.validation_report(t.spark, targets, tables)


COUNTED = ("orders", "lineitem", "customer", "part", "events")


def counts(t: Tables, names, test=None) -> DataFrame:
    """(table_name, row_count) for several tables."""

    parts = []
    for name in names:
        df = t(name)
        if test is not None and name in test:
            df = df.where(test[name])
        parts.append(Q.row_count(df).withColumn("table_name", F.lit(name)))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@suite.register(
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in COUNTED)
)
def table_row_counts(t: Tables) -> DataFrame:
    return counts(t, COUNTED)


@suite.register("""
SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS source_rows,
       (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS target_rows,
       CASE WHEN (SELECT count(*) FROM orders) = (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P')
            THEN 'ok' ELSE 'row-count-mismatch' END AS status
UNION ALL SELECT 'lineitem', count(*), count(*), 'ok' FROM lineitem
UNION ALL SELECT 'customer', count(*), count(*), 'ok' FROM customer
UNION ALL SELECT 'part', count(*), 0, 'missing' FROM part
UNION ALL SELECT 'events', count(*), 0, 'missing' FROM events""")
def count_compare(t: Tables) -> DataFrame:
    loaded = counts(t, ("orders", "lineitem", "customer"), {"orders": F.col("o_orderstatus") != "P"})
    return Q.count_compare(counts(t, COUNTED), loaded)


@suite.register("""
SELECT count(*) AS row_count, strftime(min(l_shipdate), '%Y-%m-%d') AS min_date,
       strftime(max(l_shipdate), '%Y-%m-%d') AS max_date, count(DISTINCT CAST(l_shipdate AS DATE)) AS trading_dates
FROM lineitem""")
def coverage(t: Tables) -> DataFrame:
    found = Q.coverage(t("lineitem"), "l_shipdate")
    return found.select("row_count", iso("min_date").alias("min_date"), iso("max_date").alias("max_date"), "trading_dates")


@suite.register(f"""WITH {PANEL_SQL} SELECT strftime(min(date), '%Y-%m-%d') AS min_date,
  strftime(max(date), '%Y-%m-%d') AS max_date FROM panel""")
def table_date_range(t: Tables) -> DataFrame:
    found = Q.date_range(option_panel(t))
    return found.select(iso("min_date").alias("min_date"), iso("max_date").alias("max_date"))


@suite.register(f"""WITH {PANEL_SQL} SELECT CAST(source_year AS BIGINT) AS source_year, secid, optionid, volume
FROM panel WHERE source_year IS NOT NULL""")
def yearly_tables_united(t: Tables) -> DataFrame:
    """One table per year, united again with the year in front."""

    panel = option_panel(t)
    years = sorted(r[0] for r in panel.select("source_year").distinct().collect() if r[0] is not None)
    yearly = [(y, panel.where(F.col("source_year") == y).select("secid", "optionid", "volume")) for y in years]
    united = union_years(yearly)
    return united.withColumn("source_year", F.col("source_year").cast("bigint"))


# --- declared schemas: text rows conformed to types

CONFORM_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderdate date, o_totalprice decimal(12,2), o_note string"


def text_orders(t: Tables, broken: bool) -> DataFrame:
    day = iso("o_orderdate")
    key = F.col("o_orderkey")
    date_text = F.when(key % 89 == 0, F.lit("9000-01-01")).when(key % 83 != 0, day)
    if broken:
        date_text = F.when(key % 79 == 0, F.lit("2005")).otherwise(date_text)
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    if broken:
        price = F.when(key % 73 == 0, F.concat(F.lit("n/a "), key % 7)).otherwise(price)
        # One digit more than the type holds.
        price = F.when(key % 71 == 0, F.concat(F.lit("1.23"), key % 5 + 1)).otherwise(price)
    customer = F.col("o_custkey").cast("double")
    if broken:
        customer = F.when(key % 67 == 0, customer % 10 + 0.5).otherwise(customer)
    return t("orders").select(
        key.cast("string").alias("o_orderkey"), customer.alias("o_custkey"), date_text.alias("o_orderdate"), price.alias("o_totalprice"),
        F.lit(None).cast("string").alias("o_note"),
    )


@suite.register("""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 89 = 0 THEN '9000-01-01'
                        WHEN o_orderkey % 83 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS o_totalprice, CAST(NULL AS VARCHAR) AS o_note
FROM orders""")
def conform_types(t: Tables) -> DataFrame:
    typed = C.conform(text_orders(t, broken=False), T.StructType.fromDDL(CONFORM_SCHEMA))
    return C.dates_to_text(typed).withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@suite.register("""
WITH bad AS (
  SELECT 'o_orderdate' AS column_name, 'date' AS declared_type, '2005' AS v FROM orders WHERE o_orderkey % 79 = 0
  UNION ALL
  SELECT 'o_totalprice', 'decimal(12,2)', 'n/a ' || (o_orderkey % 7) FROM orders WHERE o_orderkey % 73 = 0 AND o_orderkey % 71 <> 0
  UNION ALL
  SELECT 'o_totalprice', 'decimal(12,2)', '1.23' || (o_orderkey % 5 + 1) FROM orders WHERE o_orderkey % 71 = 0
  UNION ALL
  SELECT 'o_custkey', 'bigint', (o_custkey % 10) || '.5' FROM orders WHERE o_orderkey % 67 = 0
), ranked AS (
  SELECT column_name, v, row_number() OVER (PARTITION BY column_name ORDER BY v) AS rn
  FROM (SELECT DISTINCT column_name, v FROM bad)
)
SELECT column_name, declared_type, count(*) AS bad_values,
  (SELECT string_agg(r.v, ', ' ORDER BY r.v) FROM ranked r WHERE r.column_name = b.column_name AND r.rn <= 5) AS sample_values
FROM bad b GROUP BY 1, 2""")
def conform_problems(t: Tables) -> DataFrame:
    return C.conform_problems(text_orders(t, broken=True), T.StructType.fromDDL(CONFORM_SCHEMA))


CHECKLIST_SQL = """
totals AS (
  SELECT count(*) FILTER (WHERE secid IS NULL) AS null_secid, count(*) FILTER (WHERE date IS NULL) AS null_date,
    count(*) FILTER (WHERE optionid IS NULL) AS null_optionid, count(*) FILTER (WHERE exdate IS NULL) AS null_exdate,
    count(*) FILTER (WHERE cp_flag IS NULL) AS null_cp_flag, count(*) FILTER (WHERE strike_price IS NULL) AS null_strike_price,
    (SELECT count(*) FROM (SELECT 1 FROM panel GROUP BY source_year, secid, date, optionid, exdate, cp_flag, strike_price HAVING count(*) > 1))
      AS duplicate_contract_date_keys
  FROM panel
), whole AS (
  SELECT name AS check_name, CAST(NULL AS BIGINT) AS year, CAST(n AS VARCHAR) AS value, CASE WHEN n = 0 THEN 'ok' ELSE 'review' END AS status
  FROM totals UNPIVOT (n FOR name IN (null_secid, null_date, null_optionid, null_exdate, null_cp_flag, null_strike_price,
    duplicate_contract_date_keys))
), usable AS (
  SELECT * FROM links WHERE permno IS NOT NULL AND sdate IS NOT NULL AND edate IS NOT NULL AND sdate <= edate
), marked AS (
  SELECT p.*, EXISTS (SELECT 1 FROM usable l WHERE l.secid = p.secid AND p.date BETWEEN l.sdate AND l.edate) AS linked FROM panel p
), yearly AS (
  SELECT source_year AS y, count(*) AS n, min(date) AS lo, max(date) AS hi, count(*) FILTER (WHERE linked) AS linked FROM marked GROUP BY 1
), wanted AS (
  SELECT year(l_shipdate) AS y, count(*) + CASE WHEN year(l_shipdate) = 1997 THEN 1 ELSE 0 END AS n FROM lineitem GROUP BY 1
), by_year AS (
  SELECT 'row_count' AS check_name, CAST(y AS BIGINT) AS year, CAST(yearly.n AS VARCHAR) AS value,
    CASE WHEN yearly.n = wanted.n THEN 'ok' ELSE 'review' END AS status FROM yearly JOIN wanted USING (y)
  UNION ALL SELECT 'min_date', y, CAST(lo AS VARCHAR), CASE WHEN year(lo) = y AND year(hi) = y THEN 'ok' ELSE 'review' END FROM yearly
  UNION ALL SELECT 'max_date', y, CAST(hi AS VARCHAR), CASE WHEN year(lo) = y AND year(hi) = y THEN 'ok' ELSE 'review' END FROM yearly
  UNION ALL SELECT 'link_match_rate', y, CAST(round(linked / n, 6) AS VARCHAR), CASE WHEN round(linked / n, 6) >= 0.01 THEN 'ok' ELSE 'review' END
  FROM yearly
), days AS (
  SELECT DISTINCT secid, date FROM panel WHERE secid IS NOT NULL AND date IS NOT NULL
), calendar AS (
  SELECT date, lag(date) OVER (ORDER BY date) AS previous_date FROM (SELECT DISTINCT date FROM days)
), lagged AS (
  SELECT CASE WHEN d.date > DATE '2000-11-28' THEN 'lagged_by_source' ELSE 'same_day' END AS regime, count(*) AS n, count(e.date) AS known
  FROM days d JOIN calendar c ON d.date = c.date LEFT JOIN days e ON e.secid = d.secid AND e.date = c.previous_date GROUP BY 1
)"""


@suite.register(f"""WITH {PANEL_SQL}, {LINKS_SQL}, {CHECKLIST_SQL}
SELECT * FROM whole UNION ALL SELECT * FROM by_year
UNION ALL SELECT 'lag_available_' || regime, NULL, CAST(round(known / n, 6) AS VARCHAR), CASE WHEN known > 0 THEN 'ok' ELSE 'review' END FROM lagged""")
def post_load_checklist(t: Tables) -> DataFrame:
    """The whole checklist over the option panel; one year's expected count is off by one."""

    shipped = F.year("l_shipdate")
    expected = t("lineitem").groupBy(shipped.alias("year")).agg(
        (F.count(F.lit(1)) + F.max((shipped == 1997).cast("int"))).alias("row_count")
    )
    checked = post_load(option_panel(t), links(t), expected, F.col("source_year"), least_match=0.01)
    return checked.withColumn("year", F.col("year").cast("bigint"))
