"""Files of a layout: disjoint key ranges, order, frequent keys, nulls, texts."""

import random
from datetime import date, datetime

from pyspark.sql import functions as F

from panelforge.plans.contracts import LAYOUTS, Layout
from panelforge.sinks.layouts import QUANTILES, _cut, file_report, ranged, write_layout


def test_bounds_of_one_partition_value():
    grid = list(range(1, QUANTILES))
    assert _cut(grid, 10, 10) == ([], [])
    assert _cut(grid, 20, 10) == ([500], [])
    bounds, frequent = _cut([7] * 600 + grid[600:], 100, 10)
    assert frequent == [(7, 6)] and bounds == [7, 700, 800, 900]


def test_a_frequent_key_gets_files_of_its_own(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(50 if i % 3 == 0 else rnd.randrange(100), date(2020, 1 + i % 2, 1 + i % 28), i) for i in range(3000)]
    rows += [(None, None, -1), (3, None, -2)]
    df = spark.createDataFrame(rows, "secid bigint, date date, optionid bigint")
    path = str(tmp_path / "options")
    assert write_layout(df, path, LAYOUTS["opprcd"], file_rows=100) == len(rows)
    stored = spark.read.parquet(path)
    files = file_report(stored, LAYOUTS["opprcd"]).collect()
    assert sum(f["rows"] for f in files) == len(rows)
    assert not any(f["overlaps"] or f["unsorted"] for f in files)
    for month in (202001, 202002):
        own = [f for f in files if f["value"] == month]
        assert 10 <= len(own) <= 32 and max(f["rows"] for f in own) < 300
        hot = [f for f in own if f["first"] <= 50 <= f["last"]]
        # The frequent key fills files of its own, at most two others touch it at their ends.
        assert sum(f["first"] == f["last"] == 50 for f in hot) >= 3
    assert {r["secid"] for r in stored.where(F.col("optionid") < 0).collect()} == {None, 3}


def test_texts_and_times_keep_their_order(spark, tmp_path):
    rows = [(f"S{i % 90:03d}" + "x" * (i % 9), datetime(2021, 5, 1 + i % 20, 9, i % 60), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, volume int")
    path = str(tmp_path / "bars")
    write_layout(df, path, LAYOUTS["bars"], file_rows=150)
    files = file_report(spark.read.parquet(path), LAYOUTS["bars"]).collect()
    assert len(files) > 8 and not any(f["overlaps"] or f["unsorted"] for f in files)


def test_empty_table_and_missing_keys(spark, tmp_path):
    empty = spark.createDataFrame([], "secid bigint, date date")
    assert write_layout(empty, str(tmp_path / "empty"), LAYOUTS["opprcd"]) == 0
    rows = spark.createDataFrame([(date(2020, 1, 1), 5)], "date date, optionid bigint")
    assert write_layout(rows, str(tmp_path / "no-secid"), LAYOUTS["opprcd"]) == 1


def test_ranges_are_joined_without_a_shuffle(spark):
    """A shuffled join would gather all rows of a partition value in one task."""

    df = spark.range(3000).selectExpr("id as secid", "date'2020-01-01' as date", "'202001' as month").rdd.toDF()
    plan = ranged(df, LAYOUTS["opprcd"], file_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_disorder_is_counted_within_and_across_batches(spark, tmp_path):
    """By the full key, with no join of the rows; a file of a few batches, NaN counts as greatest."""

    rows = [(1, 2.0), (1, 1.0), (2, float("nan")), (2, 5.0), (3, 0.0), (3, float("nan")), (None, 1.0), (0, 2.0), (9, 1.0), (8, 7.0)]
    df = spark.createDataFrame(rows, "secid bigint, strike_price double").coalesce(1)
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    for size in ("3", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            report = file_report(stored, Layout(("secid", "strike_price")))
            (found,) = report.collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        # 2.0 before 1.0, NaN before 5.0, 3 before NULL (counts as 0), 9 before 8
        assert (found["rows"], found["first"], found["last"], found["unsorted"]) == (10, 0, 9, 4)
    assert "MapInArrow" in report._jdf.queryExecution().executedPlan().toString()


def test_files_are_reported_from_one_read(spark, tmp_path):
    """No second read, no join or sort of the rows; keys out of order and NaN still give the true ends of a file."""

    parts = {"2020": ["S9", "S10", "S2", None], "2021": ["b", "a", "c", "a", "b"]}
    rows = [(v, s, i) for v, symbols in parts.items() for i, s in enumerate(symbols)]
    df = spark.createDataFrame(rows, "year string, symbol string, n int").coalesce(1)
    df.write.partitionBy("year").parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        report = file_report(spark.read.parquet(str(tmp_path / "t")), Layout(("symbol",), partition="year"))
        found = {r["value"]: r for r in report.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [tuple(found[2020][c] for c in ("rows", "first", "last", "unsorted", "overlaps"))] == [(4, "", "S9", 2, False)]
    assert [tuple(found[2021][c] for c in ("rows", "first", "last", "unsorted", "overlaps"))] == [(5, "a", "c", 2, False)]
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("parquet") == 1 and "Join" not in plan
    spark.createDataFrame([(float(x),) for x in ("2", "nan", "1", "3")], "k double").coalesce(1).write.parquet(str(tmp_path / "nan"))
    (row,) = file_report(spark.read.parquet(str(tmp_path / "nan")), Layout(("k",))).collect()
    assert row["first"] == 1.0 and row["last"] != row["last"] and row["unsorted"] == 1
