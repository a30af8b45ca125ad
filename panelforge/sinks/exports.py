"""Whole-table exports: Parquet with previews, CSV, resumable worklists."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.operators.conform import conform
from panelforge.sources.tables import delete_path, entry_names, file_table_name, path_exists, rename_path

# Bytes that a Parquet file without rows, which is all footer, takes at the most.
EMPTY_FILE = 1 << 20


def output_path(folder: str, library: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{library}__{table}.parquet"


def is_complete(spark: SparkSession, path: str) -> bool:
    """A finished output: the success marker is there and every file has a readable footer."""

    if not path_exists(spark, f"{path}/_SUCCESS"):
        return False
    try:
        # No column is read; the count comes from the footers of all files.
        spark.read.schema("_unused int").option("ignoreCorruptFiles", False).parquet(path).count()
    except Exception:
        return False
    return True


def promote(spark: SparkSession, written: str, path: str) -> None:
    """Put a finished folder in the place of ``path``; the old one goes only when the new one stands."""

    old = f"{path}.replaced-{uuid.uuid4().hex}"
    there = path_exists(spark, path)
    if there:
        rename_path(spark, path, old)
    try:
        rename_path(spark, written, path)
    except Exception:
        if there:
            rename_path(spark, old, path)
        raise
    if there:
        delete_path(spark, old)


def _unreadable_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file`` of every file below ``paths`` without a readable footer, whatever their number, in one pass each over footers.

    A file whose footer is read counts its rows; broken ones are skipped there and give none.
    A file without rows is all footer, so of the silent ones only the small can be sound, and
    their bytes are looked at.
    """

    def files() -> DataFrame:
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)

    counted = (
        spark.read.option("recursiveFileLookup", "true").schema("_unused int").option("ignoreCorruptFiles", "true").parquet(*paths)
        .groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    )
    silent = files().select(F.col("_metadata.file_path").alias("file")).join(counted, "file", "left_anti")
    # Format constants: the mark at both ends, and before the last one the footer's length, low byte first.
    mark, low_first = F.lit(b"PAR1"), F.expr("hex(substring(content, length(content) - 7, 4))")
    footer = F.conv(F.concat(*[F.substring(low_first, i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("bigint")
    whole = (
        (F.expr("substring(content, 1, 4)") == mark) & (F.expr("substring(content, length(content) - 3, 4)") == mark)
        & (footer + 12 == F.col("length"))
    )
    sound = (
        files().where(F.col("length").between(12, EMPTY_FILE))
        .select(F.col("_metadata.file_path").alias("file"), whole.alias("whole")).where("whole").select("file")
    )
    return silent.join(sound, "file", "left_anti")


def completed_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """(library, table_name) of the finished outputs of an export folder.

    The folder is listed; the footers of all marked outputs are then checked together, so the
    number of Spark jobs does not grow with the number of outputs.
    """

    marked = []
    if path_exists(spark, folder):
        for name in entry_names(spark, folder):
            library, mark, table = name.removesuffix(".parquet").partition("__")
            if mark and name.endswith(".parquet") and path_exists(spark, f"{folder.rstrip('/')}/{name}/_SUCCESS"):
                marked.append((library, table, name.removesuffix(".parquet")))
    known = spark.createDataFrame(marked, "library string, table_name string, output string")
    if not marked:
        return known.drop("output")
    broken = _unreadable_files(spark, [f"{folder.rstrip('/')}/{name}.parquet" for *_, name in marked])
    outputs = broken.select(file_table_name(F.col("file"), folder).alias("output"))
    return known.join(outputs, "output", "left_anti").drop("output")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_holdings_csv(holdings: DataFrame, path: str) -> None:
    """Holdings CSV; an empty set is an error."""

    if holdings.isEmpty():
        raise ValueError(f"no rows to write for {path}")
    write_csv(holdings, path)


def export_table(
    df: DataFrame,
    folder: str,
    library: str,
    table: str,
    schema: T.StructType | None = None,
    resume: bool = False,
    preview_rows: int = 0,
) -> int:
    """Write one table as zstd Parquet and return the number of rows written.

    With ``resume`` a finished output is left alone (0 rows). An unfinished or
    unreadable one is rewritten. Rows go to a folder beside the output, which takes the
    output's place when it is complete, so a failing rewrite keeps the old one. The
    row count is observed during the write, and an empty table still leaves files that
    carry the schema.
    """

    spark = df.sparkSession
    path = output_path(folder, library, table)
    if resume and is_complete(spark, path):
        return 0
    rows = conform(df, schema) if schema is not None else df
    seen = Observation()
    written = f"{folder.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    try:
        (
            rows.observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.option("compression", "zstd").parquet(written)
        )
        promote(spark, written, path)
    except Exception:
        delete_path(spark, written)
        raise
    if preview_rows > 0:
        write_csv(spark.read.parquet(path).limit(preview_rows), f"{folder.rstrip('/')}/{library}__{table}__sample.csv")
    return int(seen.get["rows"])


def export_worklist(selected: DataFrame, completed: DataFrame) -> DataFrame:
    """Selected tables without a finished output."""

    return selected.join(completed, ["library", "table_name"], "left_anti")


def export_samples(
    spark: SparkSession, tables: Iterable[tuple[str, str, DataFrame]], folder: str, rows: int
) -> list[str]:
    """First rows of every table as CSV, one folder per library."""

    if rows <= 0:
        raise ValueError("the number of sampled rows must be positive")
    written = []
    for library, table, df in tables:
        path = f"{folder.rstrip('/')}/{library}/{table}.csv"
        write_csv(df.limit(rows), path)
        written.append(path)
    return written


def write_rejects(rejected: DataFrame, path: str) -> None:
    """Append rejected bar lines with the time of the rejection."""

    stamped = rejected.withColumn("rejected_at", F.current_timestamp())
    stamped.write.mode("append").json(path)
