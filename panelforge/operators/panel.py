"""Panel analytics: identifier links, prices, volume totals, lags, volatility."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.sliding import window_deviations
from panelforge.session import land

# Fixed value: open interest is published with a one-day lag after this date.
OPEN_INTEREST_LAG_DATE = "2000-11-28"

# Calendar-day windows of the historical volatility table.
VOLATILITY_WINDOWS = (10, 14, 30, 60, 91, 122, 152, 182, 273, 365, 547, 730, 1825)

# The documented labels of calls and puts.
CALL_PUT = ("C", "P")

# Fixed value: strike prices are stored as dollars times this factor.
STRIKE_SCALE = 1000


def usable_links(links: DataFrame, score: int | None = None) -> DataFrame:
    """Links with an identifier and both bounds, optionally of one score only."""

    kept = links.where(
        F.col("permno").isNotNull() & F.col("sdate").isNotNull() & F.col("edate").isNotNull()
        & (F.col("sdate") <= F.col("edate"))
    )
    return kept if score is None else kept.where(F.col("score") == score)


def link_join(
    panel: DataFrame, links: DataFrame, score: int | None = None, how: str = "left",
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Attach the identifier whose date range covers the panel date.

    Each link is repeated once per calendar year it touches and the join runs
    on (secid, year) with the date range as residual. A secid that holds a
    large part of the panel is thereby split by year, and a row is compared
    only with links of its own year. The repetition is bounded by the years of
    the panel, to which open-ended links are clipped. ``years`` states them, as
    the load plan or the partition values know them; without it they cost one
    more scan of the date column. Panel rows outside stated years find no link.
    """

    if years is not None:
        first_year, last_year = F.lit(years[0]), F.lit(years[1])
    else:
        first_year = panel.agg(F.min(F.year("date"))).scalar()
        last_year = panel.agg(F.max(F.year("date"))).scalar()
    spread = (
        usable_links(links, score)
        .withColumn("_first", F.greatest(F.year("sdate"), first_year))
        .withColumn("_last", F.least(F.year("edate"), last_year))
        .where(F.col("_first") <= F.col("_last"))
        .select(
            F.col("secid").alias("_secid"),
            "sdate",
            "edate",
            "permno",
            "score",
            F.explode(F.sequence("_first", "_last")).alias("_year"),
        )
    )
    return panel.join(
        spread,
        (panel["secid"] == spread["_secid"])
        & (F.year(panel["date"]) == spread["_year"])
        & panel["date"].between(spread["sdate"], spread["edate"]),
        how,
    ).drop("_secid", "_year")


def link_match_rate(linked: DataFrame) -> DataFrame:
    """Rows, linked rows and rate per calendar year of a left-linked panel."""

    return (
        linked.groupBy(F.year("date").alias("year"))
        .agg(F.count(F.lit(1)).alias("panel_rows"), F.count("permno").alias("linked_rows"))
        .withColumn("match_rate", F.round(F.col("linked_rows") / F.col("panel_rows"), 6))
    )


def attach_underlying(options: DataFrame, prices: DataFrame) -> DataFrame:
    """Underlying close and return on (secid, date), strike in dollars, moneyness.

    ``prices`` must hold one row per (secid, date). It should come from storage, not
    straight from a grouping: a hot (secid, date) of options can be split only when the
    join reads both sides from a plain shuffle.
    """

    under = prices.select("secid", "date", F.col("close").alias("underlying_close"),
                          F.col("return").alias("underlying_return"))
    strike = F.col("strike_price") / STRIKE_SCALE
    return (
        options.join(under, ["secid", "date"], "left")
        .withColumn("strike_dollars", strike)
        .withColumn(
            "moneyness", F.when(F.col("underlying_close") != 0, strike / F.col("underlying_close"))
        )
    )


def volume_totals(options: DataFrame, labels: Sequence[str] = CALL_PUT) -> DataFrame:
    """Volume and open interest per (secid, date, call/put) plus a total row.

    One grouping on (secid, date) sums the documented ``labels``, unlabelled contracts and
    the total side by side, with partial sums before its one shuffle. Contracts of any other
    label, of which a clean table has none, are grouped by themselves; the scan for them is
    pruned by file statistics. ``cp_flag`` is NULL on total rows, which ``is_total`` tells
    apart from unlabelled contracts.
    """

    label = F.col("cp_flag")
    lines = [(F.lit(x), F.lit(False), label == x) for x in labels]
    lines += [(F.lit(None).cast("string"), F.lit(False), label.isNull()), (F.lit(None).cast("string"), F.lit(True), F.lit(True))]

    def measures(test: Column) -> list[Column]:
        return [F.sum(F.when(test, F.col(m))) for m in ("volume", "open_interest")] + [F.count_if(test)]

    names = ("volume", "open_interest", "contracts")
    sums = [m.alias(f"{name}_{i}") for i, (_, _, test) in enumerate(lines) for name, m in zip(names, measures(test))]
    daily = options.groupBy("secid", "date").agg(*sums)
    stacked = F.array(
        *[
            F.struct(flag.alias("cp_flag"), total.alias("is_total"), *[F.col(f"{n}_{i}").alias(n) for n in names])
            for i, (flag, total, _) in enumerate(lines)
        ]
    )
    known = daily.select("secid", "date", F.explode(stacked).alias("t")).select("secid", "date", "t.*").where("contracts > 0")
    other = options.where(label.isNotNull() & ~label.isin(*labels)).groupBy("secid", "date", "cp_flag").agg(
        *[m.alias(n) for n, m in zip(names, measures(F.lit(True)))]
    )
    return known.unionByName(other.withColumn("is_total", F.lit(False)))


def lag_trading_day(panel: DataFrame, keys: Sequence[str], value: str, date_column: str = "date") -> DataFrame:
    """Value of the previous trading day, NULL when the key has no row that day.

    Trading days are the dates that occur anywhere in the panel. ``panel`` must
    hold one row per key and date, so both the calendar and the rows of one key
    are bounded by the number of days. The calendar holds whole days whatever
    the column's type, is numbered in one small task and stored, so Spark knows
    how small it is; the panel is shuffled once, by key.
    """

    panel = panel.withColumn(date_column, F.col(date_column).cast("date"))
    day = F.col(date_column)
    calendar = panel.select(day.alias("_day")).distinct()
    calendar = land(
        calendar.select("_day", F.lag("_day").over(Window.orderBy("_day")).alias("previous_date")), "trading-days"
    )
    in_order = Window.partitionBy(*keys).orderBy(date_column)
    earlier = panel.select(
        "*",
        F.lag(date_column).over(in_order).alias("_earlier_day"),
        F.lag(value).over(in_order).alias("_earlier_value"),
    )
    return (
        earlier.join(calendar, day == F.col("_day"), "left")
        .withColumn(
            f"lagged_{value}",
            F.when(F.col("_earlier_day") == F.col("previous_date"), F.col("_earlier_value")),
        )
        .withColumn(
            "regime",
            F.when(day > F.lit(OPEN_INTEREST_LAG_DATE).cast("date"), "lagged_by_source").otherwise("same_day"),
        )
        .drop("_day", "_earlier_day", "_earlier_value")
    )


def historical_volatility(
    returns: DataFrame,
    windows: Sequence[int] = VOLATILITY_WINDOWS,
    key: str = "secid",
    date_column: str = "date",
    return_column: str = "return",
    annualize: float | None = None,
    min_observations: int = 2,
) -> DataFrame:
    """Realized volatility of log total returns over calendar-day windows.

    Output: key, date, window_days, observations, volatility. ``returns`` holds
    one row per key and date, so a key is bounded by the calendar.

    Rows are shuffled once, by key, and sorted; :func:`sliding.window_deviations` then merges
    moments of blocks of rows, so neither every calendar day nor a sum over the whole history
    is formed, and an outlier leaves a window without a trace. A return that is NaN, infinite
    or not above -1 counts as missing. Rows without a date have no window and are left out.
    """

    plain = F.when(F.col(return_column) > -1, F.log1p(F.col(return_column)))
    finite = F.when(~F.isnan(plain) & (F.abs(plain) < F.lit(float("inf"))), plain)
    light = returns.select(key, F.col(date_column).cast("date").alias(date_column), finite.alias("log_return"))
    kind = light.schema[key].dataType.simpleString()
    measure = window_deviations(tuple(windows), min_observations, 1.0 if annualize is None else float(annualize) ** 0.5)
    return (
        light.where(F.col(date_column).isNotNull()).repartition(key).sortWithinPartitions(key, date_column)
        .mapInArrow(
            measure, f"`{key}` {kind}, `{date_column}` date, window_days int, observations bigint, volatility double"
        )
    )
