"""Partitioned, sorted Parquet in the layout of each table family."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.digests import rows_fingerprint
from panelforge.plans.contracts import LAYOUTS, Layout, default_sort_columns

EPOCH = "1970-01-01"
# The rows of a file are sorted in one task: so many fit its share of an executor's memory
# unspilled, some 400 bytes each, and make about one reader task's worth of file.
FILE_ROWS = 2_000_000
# Bytes that a row takes at the least in Spark's statistics of a plan.
SMALL_ROW = 16
# Steps of a partition value's quantiles, and so the most ranges it is cut into.
QUANTILES = 1000


def month_of(column: str) -> Column:
    """yyyyMM of a date or timestamp; NULL falls into the epoch's month."""

    return F.date_format(F.coalesce(F.col(column).cast("date"), F.lit(EPOCH).cast("date")), "yyyyMM")


def sort_value(df: DataFrame, column: str) -> Column:
    """Sort key with NULL replaced by the type's neutral value."""

    kind = df.schema[column].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(F.col(column), F.lit(EPOCH).cast(kind))
    if isinstance(kind, T.StringType):
        return F.coalesce(F.col(column), F.lit(""))
    return F.coalesce(F.col(column), F.lit(0).cast(kind))


def order_number(df: DataFrame, column: str) -> Column:
    """A number that grows with the sort key; texts that share their first seven bytes share it."""

    kind, value = df.schema[column].dataType, sort_value(df, column)
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.substring(F.hex(F.encode(value, "UTF-8")), 1, 14), 14, "0"), 16, 10).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    return value if isinstance(kind, T.NumericType) else F.lit(0)


def _cut(quantiles: list, rows: int, file_rows: int) -> tuple[list, list]:
    """Bounds of the ranges of one partition value, and (value, files) for values that fill several files."""

    files = min(max(1, -(-rows // file_rows)), QUANTILES)
    picked = [quantiles[i * QUANTILES // files - 1] for i in range(1, files)]
    bounds = sorted(set(picked))
    return bounds, [(b, picked.count(b)) for b in bounds if picked.count(b) > 1]


def ranged(df: DataFrame, layout: Layout, file_rows: int = FILE_ROWS) -> DataFrame:
    """Rows arranged for the write: whole (partition value, range of the leading key) per task, sorted by the whole key.

    A first pass over the two columns (partition value, leading key) counts the rows of each
    value and sketches its quantiles; partial sketches merge, so one row per value, of which
    the calendar has few, reaches the driver. Values of more than ``file_rows`` rows are cut
    into ranges at the quantiles, small ones share a task, and one shuffle by task number
    brings them there; the ranges are broadcast, for a join that shuffled would bring all rows
    of a value to one task. Files of a month therefore have disjoint key ranges, and a reader that
    looks for an id opens one. A key so frequent that it fills several files gets files of its
    own, its rows dealt by the rest of the sort key; other keys never share them.

    Rows that Spark's statistics put below ``file_rows * SMALL_ROW`` bytes are dealt by value
    alone, without the first pass: a value stays in one task, so its files are disjoint too.
    """

    value = F.col(layout.partition)
    present = [c for c in layout.sort_keys if c in df.columns]
    keys = [value, *[sort_value(df, c) for c in present]]
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= file_rows * SMALL_ROW:
        return df.repartition(layout.partition).sortWithinPartitions(*keys)

    lead = order_number(df, present[0]) if present else F.lit(0)
    shares = [i / QUANTILES for i in range(1, QUANTILES)]
    counted = df.select(value.alias("value"), lead.alias("lead")).groupBy("value").agg(
        F.count(F.lit(1)).alias("rows"), F.percentile_approx("lead", shares, 10 * QUANTILES).alias("quantiles")
    )
    found = counted.collect()
    # Tasks of a file's rows, or of fewer where that would leave cores idle.
    cores = df.sparkSession.sparkContext.defaultParallelism
    task_rows = min(file_rows, -(-sum(r["rows"] for r in found) // (2 * cores)))
    ranges, task, room = [], 0, task_rows
    for row in sorted(found, key=lambda r: (r["value"] is not None, r["value"])):
        bounds, frequent = _cut(row["quantiles"], row["rows"], file_rows)
        if bounds or row["rows"] > room:
            task, room = task + (room < task_rows), task_rows
        first, last = task, task + len(bounds)
        own = []
        for _, files in frequent:
            own.append(last + 1)
            last += files
        ranges.append((row["value"], first, bounds, [v for v, _ in frequent], own, [n for _, n in frequent]))
        task, room = (last + 1, task_rows) if bounds else (task, room - row["rows"])
    kind, number = df.schema[layout.partition].dataType.simpleString(), counted.schema["quantiles"].dataType.elementType.simpleString()
    table = df.sparkSession.createDataFrame(
        ranges, f"_value {kind}, _first int, _bounds array<{number}>, _frequent array<{number}>, _own array<int>, _files array<int>"
    )
    rest = [F.col(c) for c in present[1:]] or [F.lit(0)]
    at = F.array_position("_frequent", F.col("_lead")).cast("int")
    slot = F.when(at > 0, F.get("_own", at - 1) + F.pmod(F.hash(*rest), F.get("_files", at - 1))).otherwise(
        F.col("_first") + F.size(F.filter("_bounds", lambda b: b <= F.col("_lead")))
    )
    placed = (
        df.withColumn("_lead", lead).join(F.broadcast(table), value.eqNullSafe(F.col("_value")), "left")
        .withColumn("_task", F.coalesce(slot, F.lit(0)))
        .repartitionById(task + 1, "_task")
    )
    return placed.sortWithinPartitions(*keys).select(*df.columns)


def laid_out(df: DataFrame, layout: Layout, file_rows: int = FILE_ROWS) -> DataFrame:
    """Rows arranged for the write.

    Partitioned tables go by :func:`ranged`. Tables without partitions are only sorted where
    they are, with no shuffle. Every file is sorted, so readers skip row groups and pages by
    their statistics.
    """

    if layout.partition == "month":
        df = df.withColumn("month", month_of(layout.month_of))
    keys = [c for c in layout.sort_keys if c in df.columns]
    if layout.partition:
        return ranged(df, layout, file_rows)
    return df.sortWithinPartitions(*[sort_value(df, c) for c in keys]) if keys else df


def write_layout(df: DataFrame, path: str, layout: Layout, mode: str = "errorifexists", file_rows: int = FILE_ROWS) -> int:
    """zstd Parquet in a layout; returns the rows written.

    Spark's commit makes the write all-or-nothing. Rows are counted on their
    way into the files, behind the shuffle, where each passes once.
    """

    return int(_written(df, path, layout, mode, file_rows, {})["rows"])


def write_fingerprinted(
    df: DataFrame, path: str, layout: Layout, mode: str = "errorifexists", file_rows: int = FILE_ROWS
) -> tuple[int, str]:
    """As :func:`write_layout`; also returns the fingerprint of the rows, taken in the same pass."""

    seen = _written(df, path, layout, mode, file_rows, {"fingerprint": rows_fingerprint(df.columns)})
    return int(seen["rows"]), seen["fingerprint"]


def _written(df: DataFrame, path: str, layout: Layout, mode: str, file_rows: int, also: dict[str, Column]) -> dict:
    seen = Observation()
    watched = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in also.items()]]
    writer = (
        laid_out(df, layout, file_rows).observe(seen, *watched).write.mode(mode)
        .option("compression", "zstd").option("maxRecordsPerFile", 2 * file_rows)
        # A replaced table must lose its old partitions too.
        .option("partitionOverwriteMode", "static")
    )
    if layout.partition:
        writer = writer.partitionBy(layout.partition)
    writer.parquet(path)
    return seen.get


def _order_breaks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and file split, from rows of (value, file, split, keys): ``count`` of rows, ``wrong`` neighbours, its end keys.

    ``low`` and ``high`` are the least and greatest leading key of those rows.
    """

    def less(x: pa.Array, y: pa.Array) -> pa.Array:
        found = pc.less(x, y)
        return pc.or_(found, pc.and_not(pc.is_nan(y), pc.is_nan(x))) if pa.types.is_floating(x.type) else found

    def same(x: pa.Array, y: pa.Array) -> pa.Array:
        found = pc.equal(x, y)
        return pc.or_(found, pc.and_(pc.is_nan(x), pc.is_nan(y))) if pa.types.is_floating(x.type) else found

    for place, batch in enumerate(batches):
        rows = batch.num_rows
        if not rows:
            continue
        value, file, split, *keys = batch.columns
        together = pc.and_(same(file[:-1], file[1:]), same(split[:-1], split[1:])).to_numpy(zero_copy_only=False)
        wrong, tied = less(keys[0][1:], keys[0][:-1]), same(keys[0][1:], keys[0][:-1])
        for key in keys[1:]:
            wrong = pc.or_(wrong, pc.and_(tied, less(key[1:], key[:-1])))
            tied = pc.and_(tied, same(key[1:], key[:-1]))
        wrong = np.append(0, wrong.to_numpy(zero_copy_only=False) & together)
        starts = np.append(0, np.flatnonzero(~together) + 1)
        ends = np.append(starts[1:] - 1, rows - 1)
        wrong = np.add.reduceat(wrong, starts)
        # Rows in order have their least and greatest leading key at the ends.
        low, high = starts.copy(), ends.copy()
        for i in np.flatnonzero(wrong):
            order = pc.sort_indices(keys[0][int(starts[i]) : int(ends[i]) + 1])
            low[i], high[i] = starts[i] + order[0].as_py(), starts[i] + order[-1].as_py()
        names = [f"k{i}" for i in range(len(keys))]
        yield pa.RecordBatch.from_arrays(
            [
                *[c.take(pa.array(starts)) for c in (value, file, split)], pa.array(np.full(len(starts), place), pa.int64()),
                pa.array(ends - starts + 1, pa.int64()), pa.array(wrong, pa.int64()),
                *[keys[0].take(pa.array(at)) for at in (low, high)],
                *[pa.StructArray.from_arrays([k.take(pa.array(at)) for k in keys], names) for at in (starts, ends)],
            ],
            ["value", "file", "split", "place", "count", "wrong", "low", "high", "first_key", "last_key"],
        )


def file_report(stored: DataFrame, layout: Layout) -> DataFrame:
    """Per file of a stored table: ``value``, ``file``, ``rows``, ``first``, ``last``, ``unsorted``, ``overlaps``.

    ``first`` and ``last`` are the least and greatest leading key. ``unsorted`` counts
    neighbours that are out of order by the full sort key. All are found where the rows are
    read, once; a batch leaves one row per file split, whose ends meet those of the next, so no
    row is shuffled or sorted and no file has to be one group. ``overlaps`` tells that the file begins before
    an earlier one of its partition value ends; files of one single key may follow each other.
    """

    present = [c for c in layout.sort_keys if c in stored.columns]
    value = F.col(layout.partition) if layout.partition else F.lit(None).cast("string")
    placed = stored.select(
        value.alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        *[sort_value(stored, c).alias(f"k{i}") for i, c in enumerate(present)],
    )
    kinds = {name: field.dataType.simpleString() for name, field in zip(placed.columns, placed.schema)}
    keys = ", ".join(f"k{i}: {kinds[f'k{i}']}" for i in range(len(present)))
    pieces = placed.mapInArrow(
        _order_breaks,
        f"value {kinds['value']}, file string, split bigint, place bigint, count bigint, wrong bigint, "
        f"low {kinds['k0']}, high {kinds['k0']}, first_key struct<{keys}>, last_key struct<{keys}>",
    )
    before = F.lag("last_key").over(Window.partitionBy("file").orderBy("split", "place"))
    files = pieces.withColumn("_before", before).groupBy("value", "file").agg(
        F.sum("count").alias("rows"), F.min("low").alias("first"), F.max("high").alias("last"),
        (F.sum("wrong") + F.count_if(F.col("first_key") < F.col("_before"))).alias("unsorted"),
    )
    earlier = Window.partitionBy("value").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("overlaps", F.coalesce(F.max("last").over(earlier) > F.col("first"), F.lit(False)))


def layout_for(family: str, columns: list[str]) -> Layout:
    """The family's layout, or a sort by the usual id and date columns."""

    return LAYOUTS.get(family) or Layout(tuple(default_sort_columns(columns)))
