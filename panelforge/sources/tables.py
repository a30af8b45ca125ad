"""Table scans: named columns, whole tables, samples, discovery, catalog files."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; a named column list prunes the read, an empty one is an error."""

    df = spark.read.parquet(path)
    if columns is None:
        return df
    if not columns:
        raise ValueError(f"no columns requested for {path}")
    return df.select(*columns)


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str] | None = None,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 100_000,
    **options: str,
) -> DataFrame:
    """Database scan with bounded fetches; a numeric column splits it into parallel reads."""

    if columns is not None and not columns:
        raise ValueError(f"no columns requested for {table}")
    reader = (
        spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", str(fetch_size))
    )
    if split_column is not None and bounds is not None:
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(partitions))
        )
    for key, value in options.items():
        reader = reader.option(key, value)
    df = reader.load()
    return df if columns is None else df.select(*columns)


def sample_rows(df: DataFrame, rows: int, order: Sequence[str] = ()) -> DataFrame:
    """First rows of a table; with an order the same rows come back every time."""

    if rows <= 0:
        raise ValueError("the number of sampled rows must be positive")
    return (df.orderBy(*order) if order else df).limit(rows)


def file_table_name(file_path, folder: str):
    """Table name of an output in ``folder``: the entry below it, which ends in ``.parquet``.

    Partition folders and part files below the entry do not matter.
    """

    below = re.escape(folder.rstrip("/").split("://")[-1].removeprefix("file:").rsplit("/", 1)[-1])
    return F.regexp_extract(file_path, rf"^.*?/{below}/([^/]+)\.parquet(?:/.*)?$", 1)


def discover_tables(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, row_count) for every Parquet output in a folder, by name.

    Listing goes through the cluster file system; a missing folder or one
    without Parquet files is an error. Tables without rows are kept.
    """

    names = sorted(n[: -len(".parquet")] for n in entry_names(spark, folder) if n.endswith(".parquet"))
    if not names:
        raise FileNotFoundError(f"no .parquet files found in {folder}")
    paths = [f"{folder.rstrip('/')}/{name}.parquet" for name in names]
    known = spark.createDataFrame([(name,) for name in names], "table_name string")
    # The tables differ in schema, so only an empty projection with the file
    # name is read: counts come from the footers.
    counted = (
        spark.read.schema("_unused int")
        .option("recursiveFileLookup", "true")
        .parquet(*paths)
        .groupBy(file_table_name(F.col("_metadata.file_path"), folder).alias("table_name"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return known.join(counted, "table_name", "left").select(
        "table_name", F.coalesce("n", F.lit(0)).alias("row_count")
    )


def entry_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder; a missing folder is an error."""

    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise FileNotFoundError(f"folder does not exist: {folder}")
    return [status.getPath().getName() for status in fs.listStatus(path)]


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    """Rename a file or folder on the cluster file system; failure is an error."""

    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(old), jvm.org.apache.hadoop.fs.Path(new)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"could not rename {old} to {new}")


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a declared schema."""

    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


def distinct_library_names(names: Iterable[str]) -> list[str]:
    """Configured names: trimmed, blanks dropped, first occurrence kept."""

    kept = list(dict.fromkeys(name.strip() for name in names if name.strip()))
    if not kept:
        raise ValueError("at least one library name is needed")
    return kept
