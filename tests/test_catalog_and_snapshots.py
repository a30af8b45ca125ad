"""Catalog, selection, lookup and snapshot operators on small literals."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelforge.operators import catalog as K
from panelforge.operators import quality as Q
from panelforge.operators import snapshots as S


def test_selection_rules(spark):
    live = spark.createDataFrame([("a", "t1"), ("a", "t2"), ("b", "u1"), ("c", "v1")], "library string, table_name string")
    libs = spark.createDataFrame(
        [("a", 0, True, True), ("b", 1, True, False), ("c", 2, False, True)],
        "library string, library_position int, enabled boolean, download_all boolean",
    )
    enabled = spark.createDataFrame([("b", "u1", 0)], "library string, table_name string, table_position int")
    disabled = spark.createDataFrame([("a", "t2"), ("a", "gone")], "library string, table_name string")
    chosen = K.select_tables(live, libs, enabled, disabled)
    assert sorted((r.library, r.table_name) for r in chosen.collect()) == [("a", "t1"), ("b", "u1")]
    assert K.selection_filter(chosen, "b").count() == 1
    with pytest.raises(ValueError, match="no tables match"):
        K.selection_filter(chosen, "c")
    missing = enabled.withColumn("table_name", F.lit("nope"))
    with pytest.raises(Exception, match="enabled table does not exist: nope"):
        K.select_tables(live, libs, missing, disabled).collect()
    problems = sorted(tuple(r) for r in K.selection_problems(live, missing, disabled).collect())
    assert problems == [("a", "gone", "stale disabled table"), ("b", "nope", "unknown enabled table")]


def test_lookup_first_row_and_null_keys(spark):
    left = spark.createDataFrame([(" a", "old"), (None, "old"), ("z", "old")], "library string, d string")
    lookup = spark.createDataFrame([("a ", "late", 2), ("a", "early", 1), (None, "none", 3)], "k string, d string, n int")
    merged = K.merge_lookup(left, lookup, "library", "k", "n", ["d"])
    assert sorted((str(r.library), str(r.d)) for r in merged.collect()) == [("None", "none"), ("a", "early"), ("z", "None")]
    assert [tuple(r) for r in K.merge_counts(merged, ["d"]).collect()] == [("d", 2, 1)]


def test_library_summary_ignores_null_libraries(spark):
    df = spark.createDataFrame(
        [("l", f"t{i}", 10, None if i else 5, 2, " x " if i == 3 else " ") for i in range(7)] + [(None, "t", 1, 1, 1, "")],
        "library string, table_name string, estimated_rows bigint, total_table_bytes bigint, column_count bigint, table_comment string",
    )
    (row,) = K.library_summary(df).collect()
    assert (row.table_count, row.total_table_bytes, row.commented_table_count) == (7, 5, 1)
    assert row.sample_table_names == "t0, t1, t2, t3, t4" and row.example_table_comment == "x"


def test_snapshot_diff_equals_counter(spark):
    rng = random.Random(5)
    left = [(rng.randrange(4), rng.choice(["a", None, "a|1:b"])) for _ in range(60)]
    right = [(rng.randrange(4), rng.choice(["a", None, "a|1:b"])) for _ in range(60)]
    schema = "k int, t string"
    out = S.snapshot_diff(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)).collect()
    a, b = Counter(left), Counter(right)
    want = sorted([("local_only", n, str(k)) for k, n in (a - b).items()] + [("live_only", n, str(k)) for k, n in (b - a).items()])
    assert sorted((r.side, r.copies, str((r.k, r.t))) for r in out) == want
    same = spark.createDataFrame(left, schema)
    assert S.snapshot_diff(same, same).count() == 0


@pytest.mark.parametrize(
    "local,live,issues,status",
    [(5, 5, 0, "GOOD_MATCH"), (5, 6, 0, "GOOD_OLDER_SNAPSHOT"), (5, 6, 1, "DRIFT_REVIEW"), (6, 5, 0, "DRIFT_REVIEW")],
)
def test_drift_status(spark, local, live, issues, status):
    counts = lambda n: spark.createDataFrame([("t", n)], "table_name string, row_count bigint")
    outcomes = ["changed"] * issues + ["match"] * (25 - issues)
    compared = spark.createDataFrame([("t", o) for o in outcomes], "table_name string, outcome string")
    row = S.drift_report(counts(local), counts(live), compared).first()
    assert (row.status, row.difference, row.sample_issues) == (status, live - local, issues)


def test_count_compare(spark):
    source = spark.createDataFrame([("a", 2), ("b", 2), ("c", 0)], "table_name string, row_count bigint")
    target = spark.createDataFrame([("a", 2), ("b", 1)], "table_name string, row_count bigint")
    got = {r.table_name: r.status for r in Q.count_compare(source, target).collect()}
    assert got == {"a": "ok", "b": "row-count-mismatch", "c": "missing"}


def test_yearly_summary_literals(spark):
    df = spark.range(3).select(F.lit(2023).alias("y"), F.lit("2023-05-01").cast("date").alias("date"))
    got = sorted(tuple(r) for r in Q.yearly_summary(df, "y", "date", [2023, 2024]).collect())
    assert got == [(2023, 3, "2023-05-01", "2023-05-01"), (2024, 0, "", "")]


def test_unreadable_target_is_reported(spark, tmp_path):
    report = Q.validation_report(spark, [("opprcd2020", "opprcd", [])], {"opprcd2020": str(tmp_path / "none")}).collect()
    assert [r.check_name for r in report] == ["missing_or_unreadable"]


def test_sample_positions_are_bounded_and_stable(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("t"), "id")
    first = sorted((r.t, r.position, r.id) for r in S.sample_positions(df, "t", ["id"], 5).collect())
    again = sorted((r.t, r.position, r.id) for r in S.sample_positions(df.repartition(7), "t", ["id"], 5).collect())
    assert first == again and len(first) == 15


def test_scratch_folder_is_removed(spark, tmp_path):
    from panelforge.session import land, scratch

    with scratch(spark, str(tmp_path / "own")) as path:
        assert land(spark.range(3), "three").count() == 3
        assert (tmp_path / "own").exists() and path.endswith("own")
    assert not (tmp_path / "own").exists()


def shuffled_rows(spark):
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm
    none = jvm.java.util.ArrayList()
    stages = sc._jsc.sc().statusStore().stageList(none, False, False, sc._gateway.new_array(jvm.double, 0), none)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_equal_snapshots_shuffle_one_row_a_range(spark):
    rows = spark.range(20_000, numPartitions=4).select("id", (F.col("id") % 3).cast("string").alias("kind"))
    copy = rows.repartition(3, "kind")
    copy.count()
    before = shuffled_rows(spark)
    found = S.snapshot_diff(rows, rows.select("*"), [F.col("kind")])
    assert found.collect() == []
    assert shuffled_rows(spark) - before <= 3 * 8  # three ranges, eight tasks
    # One changed row: only its range is compared row by row.
    altered = rows.withColumn("kind", F.when(F.col("id") == 7, None).otherwise(F.col("kind")))
    assert sorted((r.side, r.copies, r.id, r.kind) for r in S.snapshot_diff(rows, altered, [F.col("kind")]).collect()) == [
        ("live_only", 1, 7, None), ("local_only", 1, 7, "1"),
    ]
    assert sorted((r.side, r.id) for r in S.snapshot_diff(rows, altered).collect()) == [("live_only", 7), ("local_only", 7)]
