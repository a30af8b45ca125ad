"""Links, prices, volume totals, lags and volatility on orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators import catalog as K
from panelforge.operators import panel as P
from panelforge.functions.text import legacy_root, legacy_suffix
from panelforge.suite.common import Suite, Tables, iso, number
from panelforge.suite.load_check_queries import LINKS_SQL, PANEL_SQL, links, option_panel

suite = Suite()

# --- date-ranged links: secid = customer, panel rows = orders

ORDER_PANEL_SQL = """
order_panel AS (
  SELECT o_custkey AS secid, CAST(o_orderdate AS DATE) AS date, o_orderkey FROM orders
), linked AS (
  SELECT p.*, l.permno, l.score FROM order_panel p LEFT JOIN links l
    ON p.secid = l.secid AND p.date BETWEEN l.sdate AND l.edate
   AND l.permno IS NOT NULL AND l.sdate IS NOT NULL AND l.edate IS NOT NULL
)"""


def order_panel(t: Tables) -> DataFrame:
    return t("orders").select(
        F.col("o_custkey").alias("secid"), F.col("o_orderdate").cast("date").alias("date"), "o_orderkey"
    )


@suite.register(f"""WITH {LINKS_SQL}, {ORDER_PANEL_SQL}
SELECT secid, strftime(date, '%Y-%m-%d') AS date, o_orderkey, permno, score FROM linked""")
def link_range_join(t: Tables) -> DataFrame:
    linked = P.link_join(order_panel(t), links(t))
    return linked.select("secid", iso("date").alias("date"), "o_orderkey", "permno", "score")


@suite.register(f"""WITH {LINKS_SQL}, {ORDER_PANEL_SQL}
SELECT o_orderkey, permno FROM linked WHERE score = 1""")
def link_best_score_only(t: Tables) -> DataFrame:
    return P.link_join(order_panel(t), links(t), score=1, how="inner").select("o_orderkey", "permno")


@suite.register(f"""WITH {LINKS_SQL}, {ORDER_PANEL_SQL}
SELECT year(date) AS year, count(*) AS panel_rows, count(permno) AS linked_rows,
       round(count(permno) / count(*), 6) AS match_rate FROM linked GROUP BY 1""")
def link_match_rate_by_year(t: Tables) -> DataFrame:
    return P.link_match_rate(P.link_join(order_panel(t), links(t))).withColumn("year", number("year"))


# --- underlying prices: one per part and day, from the lines shipped open

PRICES_SQL = """
prices AS (
  SELECT l_partkey AS secid, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS close, max(l_discount) AS ret
  FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2
)"""


@suite.register(f"""WITH {PANEL_SQL}, {PRICES_SQL}
SELECT p.secid, strftime(p.date, '%Y-%m-%d') AS date, p.optionid, q.close AS underlying_close,
       q.ret AS underlying_return, p.strike_price / 1000 AS strike_dollars,
       round(p.strike_price / 1000 / q.close, 9) AS moneyness
FROM panel p LEFT JOIN prices q ON p.secid = q.secid AND p.date = q.date""")
def price_attach(t: Tables) -> DataFrame:
    prices = (
        t("lineitem").where(F.col("l_linestatus") == "O")
        .groupBy(F.col("l_partkey").alias("secid"), F.col("l_shipdate").cast("date").alias("date"))
        .agg(F.max("l_extendedprice").alias("close"), F.max("l_discount").alias("return"))
    )
    joined = P.attach_underlying(option_panel(t), prices)
    return joined.select(
        "secid", iso("date").alias("date"), "optionid", "underlying_close", "underlying_return", "strike_dollars",
        F.round("moneyness", 9).alias("moneyness"),
    )


@suite.register(f"""WITH {PANEL_SQL}
SELECT secid, strftime(date, '%Y-%m-%d') AS date, cp_flag, CAST(grouping(cp_flag) AS BIGINT) AS is_total,
       CAST(sum(volume) AS BIGINT) AS volume, CAST(sum(open_interest) AS BIGINT) AS open_interest, count(*) AS contracts
FROM panel GROUP BY GROUPING SETS ((secid, date, cp_flag), (secid, date))""")
def volume_totals(t: Tables) -> DataFrame:
    totals = P.volume_totals(option_panel(t))
    return totals.select(
        "secid", iso("date").alias("date"), "cp_flag", number("is_total").alias("is_total"), "volume",
        "open_interest", "contracts",
    )


# --- open interest by contract and day; each contract misses some days

DAILY_SQL = """
daily AS (
  SELECT o_orderpriority || '/' || o_orderstatus AS contract, CAST(o_orderdate AS DATE) AS date,
         count(*) AS open_interest FROM orders GROUP BY 1, 2
), calendar AS (
  SELECT date, lag(date) OVER (ORDER BY date) AS previous_date FROM (SELECT DISTINCT date FROM daily)
)"""


@suite.register(f"""WITH {DAILY_SQL}
SELECT d.contract, strftime(d.date, '%Y-%m-%d') AS date, d.open_interest,
       strftime(c.previous_date, '%Y-%m-%d') AS previous_date, e.open_interest AS lagged_open_interest,
       CASE WHEN d.date > DATE '2000-11-28' THEN 'lagged_by_source' ELSE 'same_day' END AS regime
FROM daily d JOIN calendar c ON d.date = c.date
LEFT JOIN daily e ON e.contract = d.contract AND e.date = c.previous_date""")
def trading_day_lag(t: Tables) -> DataFrame:
    daily = t("orders").groupBy(
        F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("contract"),
        F.col("o_orderdate").cast("date").alias("date"),
    ).agg(F.count(F.lit(1)).alias("open_interest"))
    lagged = P.lag_trading_day(daily, ["contract"], "open_interest")
    return lagged.select(
        "contract", iso("date").alias("date"), "open_interest", iso("previous_date").alias("previous_date"),
        "lagged_open_interest", "regime",
    )


# --- daily returns per supplier from the value shipped

def daily_returns(t: Tables) -> DataFrame:
    closes = t("lineitem").groupBy(
        F.col("l_suppkey").alias("secid"), F.col("l_shipdate").cast("date").alias("date")
    ).agg(F.max("l_extendedprice").alias("close"))
    before = F.lag("close").over(Window.partitionBy("secid").orderBy("date"))
    change = F.col("close") / before - 1
    # Planted: NaN, which counts as missing, and now and then a return that dwarfs the others.
    day = F.dayofyear("date")
    return closes.select(
        "secid", "date",
        F.when(day % 53 == 0, F.lit(float("nan"))).when(day % 61 == 0, change + 1000).otherwise(change).alias("return"),
    )


VOLATILITY_SQL = " UNION ALL ".join(
    f"""SELECT secid, date, {w} AS window_days, count(r) OVER w{w} AS observations,
        CASE WHEN count(r) OVER w{w} >= 2 THEN stddev_samp(r) OVER w{w} END AS v
        FROM returns WINDOW w{w} AS (PARTITION BY secid ORDER BY date RANGE BETWEEN INTERVAL {w - 1} DAY PRECEDING AND CURRENT ROW)"""
    for w in P.VOLATILITY_WINDOWS
)


@suite.register(f"""WITH closes AS (
  SELECT l_suppkey AS secid, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS close FROM lineitem GROUP BY 1, 2
), returns AS (
  SELECT secid, date, CASE WHEN dayofyear(date) % 53 = 0 THEN NULL
    ELSE ln(1 + (close / lag(close) OVER (PARTITION BY secid ORDER BY date) - 1)
            + CASE WHEN dayofyear(date) % 61 = 0 THEN 1000 ELSE 0 END) END AS r FROM closes
)
SELECT secid, strftime(date, '%Y-%m-%d') AS date, CAST(window_days AS BIGINT) AS window_days, observations,
       round(v, 6) AS volatility FROM ({VOLATILITY_SQL})""")
def historical_volatility(t: Tables) -> DataFrame:
    measured = P.historical_volatility(daily_returns(t))
    return measured.select(
        "secid", iso("date").alias("date"), number("window_days").alias("window_days"), "observations",
        F.round("volatility", 6).alias("volatility"),
    )


# --- symbols, decoding, two-hop links

@suite.register("""
SELECT l_orderkey, 'P' || l_partkey AS root, CAST(l_suppkey AS VARCHAR) AS suffix, l_extendedprice / 1000 AS strike
FROM lineitem""")
def legacy_symbol_parts(t: Tables) -> DataFrame:
    symbol = F.concat(F.lit("P"), F.col("l_partkey"), F.lit("."), F.col("l_suppkey"))
    return t("lineitem").select(
        "l_orderkey", legacy_root(symbol).alias("root"), legacy_suffix(symbol).alias("suffix"),
        (F.col("l_extendedprice") / P.STRIKE_SCALE).alias("strike"),
    )


@suite.register("""
SELECT c_custkey, n_name AS nation, r_name AS region FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 6 <> 0
LEFT JOIN region ON n_regionkey = r_regionkey""")
def lookup_decode(t: Tables) -> DataFrame:
    nations = t("nation").where(F.col("n_nationkey") % 6 != 0)
    named = K.decode(t("customer"), "c_nationkey", nations, "n_nationkey", "n_name", "nation")
    keyed = K.decode(named, "c_nationkey", nations, "n_nationkey", "n_regionkey", "regionkey")
    return K.decode(keyed, "regionkey", t("region"), "r_regionkey", "r_name", "region").select(
        "c_custkey", "nation", "region"
    )


@suite.register("""
WITH person_links AS (
  SELECT o_custkey AS personid, o_orderkey AS otherid,
         CASE WHEN o_orderkey % 11 <> 0 THEN CAST(left(o_orderpriority, 1) AS DOUBLE) END AS score,
         o_orderstatus AS match_style FROM orders
), best AS (
  SELECT personid, otherid, score, match_style FROM (
    SELECT *, row_number() OVER (PARTITION BY personid ORDER BY score DESC, otherid) AS rn
    FROM person_links WHERE score IS NOT NULL AND score >= 2) WHERE rn = 1
), professionals AS (SELECT o_orderkey AS otherid, o_totalprice AS salary FROM orders WHERE o_orderkey % 5 <> 0)
SELECT c_custkey AS personid, otherid, score, match_style, salary
FROM customer LEFT JOIN best ON c_custkey = personid LEFT JOIN professionals USING (otherid)""")
def vendor_link_two_hop(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    candidates = t("orders").select(
        F.col("o_custkey").alias("personid"), key.alias("otherid"),
        F.when(key % 11 != 0, F.left("o_orderpriority", F.lit(1)).cast("double")).alias("score"),
        F.col("o_orderstatus").alias("match_style"),
    )
    professionals = t("orders").where(key % 5 != 0).select(key.alias("otherid"), F.col("o_totalprice").alias("salary"))
    people = t("customer").select(F.col("c_custkey").alias("personid"))
    best = K.best_link(candidates, "personid", "otherid", min_score=2)
    return K.linked_records(people, best, professionals, "personid", "otherid").select(
        "personid", "otherid", "score", "match_style", "salary"
    )
