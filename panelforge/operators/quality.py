"""Post-load validation: counts, ranges, key nulls, duplicates, link quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from panelforge.plans.contracts import CONTRACT_DATE_KEY, LINK_TABLE, OPTION_FAMILY, PRICE_FAMILY, REQUIRED_KEYS


def long_checks(row: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Turn one row of measures into (table, check_name, value) rows, in order."""

    pairs = F.array(
        *[F.struct(F.lit(c).alias("check_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return row.select(F.explode(pairs).alias("c")).select(F.lit(table).alias("table"), "c.check_name", "c.value")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def date_range(df: DataFrame, column: str = "date") -> DataFrame:
    return df.agg(F.min(column).cast("date").alias("min_date"), F.max(column).cast("date").alias("max_date"))


def coverage(df: DataFrame, date_column: str) -> DataFrame:
    """Rows, first and last date, number of distinct dates.

    Grouping by date first leaves one row per calendar day, so the distinct
    count costs no second expansion of the table.
    """

    daily = df.groupBy(F.col(date_column).cast("date").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return daily.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.min("d").alias("min_date"),
        F.max("d").alias("max_date"),
        F.count("d").alias("trading_dates"),
    )


def yearly_summary(df: DataFrame, year_column: str, date_column: str, years: Sequence[int]) -> DataFrame:
    """Rows and date range per requested year; years without rows show 0 and blanks."""

    spark = df.sparkSession
    # The requested years are a short driver-side list, one row each.
    wanted = spark.createDataFrame([(int(y),) for y in years], "source_year int")
    found = (
        df.where(F.col(year_column).isin([int(y) for y in years]))
        .groupBy(F.col(year_column).cast("int").alias("source_year"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(date_column).cast("date").cast("string").alias("lo"),
            F.max(date_column).cast("date").cast("string").alias("hi"),
        )
    )
    return wanted.join(found, "source_year", "left").select(
        "source_year",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce("lo", F.lit("")).alias("min_date"),
        F.coalesce("hi", F.lit("")).alias("max_date"),
    )


def key_null_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key_column, null_rows) for every key, in one pass."""

    counts = df.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
    pairs = F.array(*[F.struct(F.lit(k).alias("key_column"), F.col(k).alias("null_rows")) for k in keys])
    return counts.select(F.explode(pairs).alias("k")).select("k.*")


def duplicate_key_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many key groups hold more than one row; NULL keys group together."""

    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.count_if(F.col("n") > 1).alias("duplicate_groups"))


def link_quality(links: DataFrame) -> DataFrame:
    """Totals, missing bounds and score split of an identifier link table."""

    return links.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("permno").isNull()).alias("missing_permno"),
        F.count_if(F.col("sdate").isNull()).alias("missing_sdate"),
        F.count_if(F.col("edate").isNull()).alias("missing_edate"),
        F.count_if(F.col("score") == 1).alias("score_1_rows"),
        F.count_if((F.col("score") != 1) | F.col("score").isNull()).alias("non_score_1_rows"),
    )


def _option_checks(df: DataFrame, table: str) -> DataFrame:
    """All option checks from one grouping by the contract-date key.

    Counts, date range and key nulls follow from the grouped keys, so the table
    is scanned and shuffled once, not once per check.
    """

    keys = list(CONTRACT_DATE_KEY)
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.min("date").cast("date").alias("min_date"),
        F.max("date").cast("date").alias("max_date"),
        *[
            F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("n"))), F.lit(0)).alias(f"null_{k}")
            for k in REQUIRED_KEYS[OPTION_FAMILY]
        ],
        F.count_if(F.col("n") > 1).alias("duplicate_contract_date_keys"),
    )
    return long_checks(row, table, row.columns)


def _yearly_checks(df: DataFrame, table: str, years: Sequence[int]) -> DataFrame:
    summary = yearly_summary(df, "source_year", "date", years)
    prefix = F.concat(F.lit("source_year_"), F.col("source_year").cast("string"))
    pairs = F.array(
        *[
            F.struct(
                F.concat(prefix, F.lit(f"_{name}")).alias("check_name"), F.col(name).cast("string").alias("value")
            )
            for name in ("row_count", "min_date", "max_date")
        ]
    )
    return summary.select(F.explode(pairs).alias("c")).select(F.lit(table).alias("table"), "c.check_name", "c.value")


def target_checks(df: DataFrame, table: str, family: str, years: Sequence[int] = ()) -> DataFrame:
    """All checks of one loaded target in long form."""

    if family == OPTION_FAMILY:
        return _option_checks(df, table)
    keys = REQUIRED_KEYS.get(family, ())
    measures = [F.count(F.lit(1)).alias("row_count")]
    if family == PRICE_FAMILY and not years:
        measures += [F.min("date").cast("date").alias("min_date"), F.max("date").cast("date").alias("max_date")]
    measures += [F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys]
    if family == LINK_TABLE:
        measures += [
            F.count(F.lit(1)).alias("link_quality_row_count"),
            F.count_if(F.col("permno").isNull()).alias("missing_permno"),
            F.count_if(F.col("sdate").isNull()).alias("missing_sdate"),
            F.count_if(F.col("edate").isNull()).alias("missing_edate"),
            F.count_if(F.col("score") == 1).alias("score_1_rows"),
            F.count_if((F.col("score") != 1) | F.col("score").isNull()).alias("non_score_1_rows"),
        ]
    row = df.agg(*measures)
    checks = long_checks(row, table, row.columns)
    if years:
        checks = checks.unionByName(_yearly_checks(df, table, years))
    return checks


def validation_report(
    spark: SparkSession,
    targets: Sequence[tuple[str, str, Sequence[int]]],
    tables: Mapping[str, DataFrame | str],
) -> DataFrame:
    """(table, check_name, value) rows for every target, each target once.

    ``targets`` lists (target table, family, source years); ``tables`` maps a
    target to a DataFrame or a path. A target that cannot be read yields one
    ``missing_or_unreadable`` row.
    """

    years_of: dict[str, list[int]] = {}
    family_of: dict[str, str] = {}
    for target, family, years in targets:
        family_of.setdefault(target, family)
        years_of.setdefault(target, []).extend(years)

    report = None
    for target, family in family_of.items():
        try:
            source = tables.get(target)
            if source is None:
                raise ValueError(f"{target} is not known")
            df = spark.read.parquet(source) if isinstance(source, str) else source
            checks = target_checks(df, target, family, years_of[target])
        except (AnalysisException, ValueError) as error:
            checks = spark.createDataFrame(
                [(target, "missing_or_unreadable", (str(error).splitlines() or [type(error).__name__])[0])],
                "table string, check_name string, value string",
            )
        report = checks if report is None else report.unionByName(checks)
    if report is None:
        report = spark.createDataFrame([], "table string, check_name string, value string")
    return report


def count_compare(source_counts: DataFrame, target_counts: DataFrame) -> DataFrame:
    """Source against target row counts: ``ok``, ``row-count-mismatch`` or ``missing``."""

    target = target_counts.select("table_name", F.col("row_count").alias("target_rows"))
    return (
        source_counts.select("table_name", F.col("row_count").alias("source_rows"))
        .join(target, "table_name", "left")
        .select(
            "table_name",
            "source_rows",
            F.coalesce("target_rows", F.lit(0)).alias("target_rows"),
            F.when(F.col("target_rows").isNull(), "missing")
            .when(F.col("target_rows") == F.col("source_rows"), "ok")
            .otherwise("row-count-mismatch")
            .alias("status"),
        )
    )
