"""Which source tables go to which target, in what order and layout."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.plans.contracts import OPTION_FAMILY, PRICE_FAMILY, family_of
from panelforge.sources.audit_log import CLEARABLE, COMPLETE, SOURCE_KEY, latest_status

SINGLE = "single_table"
CONSOLIDATED = "consolidated_year_table"
SEPARATE = "separate_year_table"


@dataclass(frozen=True)
class PlannedTable:
    """One source table and its target."""

    plan_position: int
    source_library: str
    source_table: str
    target_table: str
    source_prefix: str
    source_year: int | None
    load_group: str
    layout: str

    @property
    def family(self) -> str:
        return family_of(self.source_prefix, self.source_table)

    @property
    def year_slice(self) -> int | None:
        """The year whose slice this source fills in a consolidated target."""

        return self.source_year if self.layout == CONSOLIDATED else None


def build_plan(
    static_tables: Iterable[tuple[str, str, str]] = (),
    price_years: Sequence[int] = (),
    option_years: Sequence[int] = (),
    library: str = "optionm_all",
    price_target: str = "secprd",
    option_target: str = "opprcd{year}",
) -> list[PlannedTable]:
    """Reference tables, then underlying prices, then option prices.

    ``static_tables`` lists (library, source table, target table).
    """

    rows = [(lib, table, target, table, None, "reference", SINGLE) for lib, table, target in static_tables]
    rows += [
        (library, f"{PRICE_FAMILY}{y}", price_target, PRICE_FAMILY, y, "underlying-prices", CONSOLIDATED)
        for y in price_years
    ]
    rows += [
        (library, f"{OPTION_FAMILY}{y}", option_target.format(year=y), OPTION_FAMILY, y, "option-prices", SEPARATE)
        for y in option_years
    ]
    for _, table, _, prefix, *_ in rows:
        family_of(prefix, table)
    return [PlannedTable(i, *row) for i, row in enumerate(rows)]


def target_tables(plan: Iterable[PlannedTable]) -> list[str]:
    """Targets in plan order, each once."""

    return list(dict.fromkeys(p.target_table for p in plan))


def plan_frame(spark: SparkSession, plan: Iterable[PlannedTable]) -> DataFrame:
    """The plan as rows."""

    return spark.createDataFrame(
        [
            (p.plan_position, p.source_library, p.source_table, p.target_table, p.source_prefix, p.source_year,
             p.load_group, p.layout)
            for p in plan
        ],
        "plan_position int, source_library string, source_table string, target_table string, "
        "source_prefix string, source_year int, load_group string, layout string",
    )


def pending_sources(plan: DataFrame, events: DataFrame, order=None) -> DataFrame:
    """Planned sources whose latest status is not ``complete``."""

    done = latest_status(events, order).where(F.col("status") == COMPLETE)
    return plan.join(done, list(SOURCE_KEY), "left_anti")


def clearable_sources(plan: DataFrame, events: DataFrame, order=None) -> DataFrame:
    """Planned sources left failed, interrupted or started, with that status."""

    broken = latest_status(events, order).where(F.col("status").isin(*CLEARABLE))
    return plan.join(broken, list(SOURCE_KEY))


def union_years(tables: Iterable[tuple[int, DataFrame]]) -> DataFrame:
    """Yearly tables as one, with the year in front."""

    result = None
    for year, df in tables:
        part = df.select(F.lit(year).cast("smallint").alias("source_year"), "*")
        result = part if result is None else result.unionByName(part)
    if result is None:
        raise ValueError("no yearly tables given")
    return result
