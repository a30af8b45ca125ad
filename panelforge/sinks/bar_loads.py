"""Bar folders: load with rejects, and a check of the raw files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import bars as B
from panelforge.plans.contracts import LAYOUTS
from panelforge.session import land
from panelforge.sinks.exports import write_rejects
from panelforge.sinks.layouts import write_layout
from panelforge.sources.bar_files import bar_files, number_lines, read_bar_lines

PLACE = ("split_start", "line_order")


def numbered_rejects(parsed: DataFrame, raw: DataFrame) -> DataFrame:
    """Rejected lines of lines parsed under number 0, with their real line numbers."""

    bad = number_lines(raw, parsed.where(F.col("error").isNotNull()).drop("line_number"))
    # The message begins with the file and the placeholder number.
    reason = F.substring("error", F.length("file_name") + 3, F.length("error"))
    error = F.concat("file_name", F.lit(":"), F.col("line_number").cast("string"), reason)
    return bad.select("file_name", "line_number", error.alias("error"), "line")


def load_bars(
    spark: SparkSession,
    folder: str,
    target: str,
    rejects: str,
    zone: str = "America/New_York",
    utc_symbols: Iterable[str] = (),
    clean_start: bool = False,
) -> int:
    """Append the good bars of a folder to a target by month; returns their number.

    ``clean_start`` empties the target first. Rejected lines are appended to
    the ``rejects`` folder. A folder without supported files is an error. The text is
    read once and parsed once; the writes and the line numbers come from the stored lines.
    """

    bar_files(spark, folder)
    raw = land(read_bar_lines(spark, folder), "bar-lines")
    parsed = land(B.parse_bars(raw.withColumn("line_number", F.lit(0)), PLACE), "parsed-bars")
    good = B.good_bars(parsed, zone, utc_symbols)
    loaded = write_layout(good, target, LAYOUTS["bars"], mode="overwrite" if clean_start else "append")
    write_rejects(numbered_rejects(parsed, raw), rejects)
    return loaded


def check_folder(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(report per file, numbered issues) of the raw files of a folder."""

    files = bar_files(spark, folder)
    raw = land(read_bar_lines(spark, folder), "bar-lines")
    issues = number_lines(raw, B.line_issues(raw.withColumn("line_number", F.lit(0)), PLACE).drop("line_number"))
    return B.file_report(files, issues), issues
