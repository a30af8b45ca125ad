"""Table access and the registry of queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.session import keep_methods_compiled


class Tables:
    """The Parquet tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = str(folder).rstrip("/")
        keep_methods_compiled(spark)

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def spread(df: DataFrame, rows_per_task: int = 20_000, by: Sequence[str] = ()) -> DataFrame:
    """Deal rows out to tasks of about ``rows_per_task`` for work that is heavy per row.

    The number of tasks follows the table (its count comes from the file footers) and is
    at least the number of cores. ``by`` names columns by whose ranges the rows are dealt, so
    that neighbours meet in a task; a crowded value is cut by the columns after it. The driver
    then holds a sample of some 300 rows a task.
    """

    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_task))
    return df.repartitionByRange(tasks, *by) if by else df.repartition(tasks)


Query = Callable[[Tables], DataFrame]


@dataclass
class Suite:
    """Named queries with an optional SQL text each."""

    queries: dict[str, Query] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def register(self, sql: str | None = None) -> Callable[[Query], Query]:
        def add(function: Query) -> Query:
            self.queries[function.__name__] = function
            if sql is not None:
                self.sql[function.__name__] = sql
            return function

        return add


def iso(column: str | Column) -> Column:
    """Dates as ISO text, the same in every engine."""

    c = F.col(column) if isinstance(column, str) else column
    return F.date_format(c, "yyyy-MM-dd")


def number(column: str | Column) -> Column:
    """Flags and narrow integers as bigint."""

    c = F.col(column) if isinstance(column, str) else column
    return c.cast("bigint")
