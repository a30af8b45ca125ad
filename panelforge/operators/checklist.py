"""The checklist that a loaded option panel has to pass before research uses it, from one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators.panel import lag_trading_day, link_join
from panelforge.plans.contracts import CONTRACT_DATE_KEY, OPTION_FAMILY, REQUIRED_KEYS
from panelforge.session import land

OK, REVIEW = "ok", "review"


def daily_summary(options: DataFrame, year: Column) -> DataFrame:
    """One stored row per (secid, date, year) with all that the checks need of the panel.

    Contracts are grouped first, so a security with a third of all rows is summed up before
    the shuffle by day; the panel is scanned once and its rows are shuffled once.
    """

    keys = [k for k in REQUIRED_KEYS[OPTION_FAMILY] if k not in ("secid", "date")]
    contracts = options.withColumn("_year", year.cast("int")).groupBy("_year", *CONTRACT_DATE_KEY).agg(
        F.count(F.lit(1)).alias("n"), F.sum("open_interest").alias("open_interest")
    )
    daily = contracts.groupBy("secid", F.col("date").cast("date").alias("date"), F.col("_year").alias("year")).agg(
        F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("duplicate_keys"), F.sum("open_interest").alias("open_interest"),
        *[F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("n"))), F.lit(0)).alias(f"null_{k}") for k in keys],
    )
    return land(daily, "daily-summary")


def _lines(rows: DataFrame, year: Column, *checks: tuple[str, Column, Column]) -> DataFrame:
    """(check_name, year, value, status) lines from one row of measures per year."""

    lines = F.array(
        *[
            F.struct(F.lit(name).alias("check_name"), year.cast("int").alias("year"), value.cast("string").alias("value"),
                     F.when(good, OK).otherwise(REVIEW).alias("status"))
            for name, value, good in checks
        ]
    )
    return rows.select(F.explode(lines).alias("l")).select("l.*")


def post_load_checklist(
    options: DataFrame, links: DataFrame, expected: DataFrame | None = None, year: Column | None = None, least_match: float = 0.0,
) -> DataFrame:
    """(check_name, year, value, status) of one loaded option panel.

    Per year (of the date, unless ``year`` names the table's): ``row_count`` against
    ``expected`` (year, row_count) where given, ``min_date`` and ``max_date`` inside the year,
    ``link_match_rate``, the share of rows with at least one usable link, against
    ``least_match``. For the whole panel: ``null_<key>`` for each required key,
    ``duplicate_contract_date_keys``, and for both regimes of open interest the share of
    (security, day) rows that have a row on the trading day before, ``lag_available``,
    under the regime's name. A check that finds nothing to complain about is ``ok``.
    """

    daily = daily_summary(options, F.year("date") if year is None else year)

    totals = daily.agg(
        *[
            F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("rows"))), F.lit(0)).alias(f"null_{k}") for k in ("secid", "date")
        ],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in daily.columns if c.startswith("null_")],
        F.coalesce(F.sum("duplicate_keys"), F.lit(0)).alias("duplicate_contract_date_keys"),
    )
    whole = _lines(totals, F.lit(None), *[(c, F.col(c), F.col(c) == 0) for c in totals.columns])

    placed = daily.where(F.col("secid").isNotNull() & F.col("date").isNotNull())
    linked = link_join(placed, links, how="left_semi").groupBy(F.col("year").alias("_linked_year")).agg(F.sum("rows").alias("linked"))
    yearly = daily.groupBy("year").agg(
        F.sum("rows").alias("rows"), F.min("date").alias("first"), F.max("date").alias("last")
    )
    yearly = yearly.join(linked, F.col("year").eqNullSafe(F.col("_linked_year")), "left").drop("_linked_year")
    if expected is not None:
        wanted = expected.select(F.col("year").cast("int").alias("_wanted_year"), F.col("row_count").cast("bigint").alias("_wanted"))
        yearly = yearly.join(wanted, F.col("year").eqNullSafe(F.col("_wanted_year")), "full")
    else:
        yearly = yearly.withColumns({"_wanted_year": F.lit(None).cast("int"), "_wanted": F.col("rows")})
    rows = F.coalesce("rows", F.lit(0))
    rate = F.round(F.coalesce("linked", F.lit(0)) / F.col("rows"), 6)
    inside = (F.year("first") == F.col("year")) & (F.year("last") == F.col("year"))
    by_year = _lines(
        yearly, F.coalesce("year", "_wanted_year"),
        ("row_count", rows, rows == F.coalesce("_wanted", F.lit(0))), ("min_date", F.col("first"), inside),
        ("max_date", F.col("last"), inside), ("link_match_rate", rate, rate >= least_match),
    )

    per_day = placed.groupBy("secid", "date").agg(F.coalesce(F.sum("open_interest"), F.lit(0)).alias("open_interest"))
    lagged = lag_trading_day(per_day, ["secid"], "open_interest").groupBy("regime").agg(
        F.count(F.lit(1)).alias("days"), F.count("lagged_open_interest").alias("known")
    )
    share = F.round(F.col("known") / F.col("days"), 6)
    lag = lagged.select(
        F.concat(F.lit("lag_available_"), "regime").alias("check_name"), F.lit(None).cast("int").alias("year"),
        share.cast("string").alias("value"), F.when(F.col("known") > 0, OK).otherwise(REVIEW).alias("status"),
    )
    return whole.unionByName(by_year).unionByName(lag)
