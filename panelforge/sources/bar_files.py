"""Minute-bar text files as lines with file name and line number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.operators.bars import symbol_of
from panelforge.sources.tables import entry_names


def bar_files(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the supported files of a folder, also of empty ones; none is an error."""

    # A listing, since Spark's readers leave empty files out.
    names = [(n,) for n in entry_names(spark, folder) if n.endswith(".txt")]
    files = spark.createDataFrame(names, "file_name string").where(symbol_of(F.col("file_name")).isNotNull())
    if files.isEmpty():
        raise FileNotFoundError(f"no supported bar files in {folder}")
    return files


def read_bar_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the supported ``*.txt`` files: file_name, split_start, line_order, line.

    Files are split and read in parallel. ``line_order`` grows with the line
    inside one split; :func:`number_lines` turns it into a line number where
    one is needed, so the bulk of the lines is never shuffled for numbering.
    """

    lines = (
        spark.read.option("pathGlobFilter", "*.txt")
        .text(folder)
        .select(
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.monotonically_increasing_id().alias("line_order"),
            F.col("value").alias("line"),
        )
    )
    return lines.where(symbol_of(F.col("file_name")).isNotNull())


def number_lines(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """Replace ``split_start`` and ``line_order`` of ``wanted`` rows by ``line_number``.

    Needs one row per file split: its first order value and the number of lines
    in earlier splits of the same file.
    """

    splits = lines.groupBy("file_name", "split_start").agg(
        F.min("line_order").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = (
        Window.partitionBy("file_name").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    )
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    return (
        wanted.join(splits, ["file_name", "split_start"])
        .withColumn("line_number", F.col("line_order") - F.col("_first") + F.col("_before") + 1)
        .drop("split_start", "line_order", "_first", "_before")
    )


def numbered_bar_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their line number: file_name, line_number, line."""

    lines = read_bar_lines(spark, folder)
    return number_lines(lines, lines).select("file_name", "line_number", "line")
