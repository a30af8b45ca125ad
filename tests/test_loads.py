"""Append-once loads, audit state, exports and discovery."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.plans import load_plan as P
from panelforge.plans.contracts import LAYOUTS, SOURCE_COLUMNS
from panelforge.sinks import exports as E
from panelforge.sinks import loads as L
from panelforge.sinks.layouts import write_layout
from panelforge.sources.audit_log import AUDIT_SCHEMA, latest_status, read_audit
from panelforge.sources.tables import discover_tables, distinct_library_names, read_csv, sample_rows, scan

PRICE = "secid double, date string, volume double, close double"


def whole(df, family):
    """The rows with every column of the contract; those not given are NULL."""

    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in SOURCE_COLUMNS[family]])


def prices(spark, year, volume=10.0):
    return whole(
        spark.createDataFrame([(1.0, f"{year}-01-02", volume, 9.5), (2.0, None, 3.0, None)], PRICE), "secprd"
    )


def test_source_without_a_contract_column_fails(spark, tmp_path):
    loader = L.Loader(spark, str(tmp_path))
    plan = P.build_plan(price_years=[2020])
    loader.create_targets(plan)
    with pytest.raises(ValueError, match="lacks contract columns: .*cfadj"):
        loader.load(plan, lambda p: prices(spark, 2020).drop("cfadj"))
    assert [e.status for e in loader.events().orderBy("completed_at").collect()][-1] == "failed"


def test_error_without_text_is_audited(spark, tmp_path):
    loader = L.Loader(spark, str(tmp_path))
    plan = P.build_plan(price_years=[2020])
    loader.create_targets(plan)

    class Silent:
        columns = ()

        def __getattr__(self, name):
            raise RuntimeError

    with pytest.raises(Exception):
        loader.load_one(plan[0], Silent())
    assert L.first_line(RuntimeError()) == "RuntimeError"
    assert [e.status for e in loader.events().orderBy("completed_at").collect()] == ["started", "failed"]


def test_load_resume_refuse_and_clear(spark, tmp_path):
    loader = L.Loader(spark, str(tmp_path))
    plan = P.build_plan(price_years=[2020, 2021, 2022])
    with pytest.raises(ValueError, match="missing"):
        loader.require_empty(plan[0])
    assert loader.create_targets(plan) == ["secprd"]

    def read(p):
        return prices(spark, p.source_year, 3.5 if p.source_year == 2021 else 10.0)

    with pytest.raises(Exception, match="volume must contain whole non-negative values"):
        loader.load(plan, read)
    events = loader.events().orderBy("completed_at").collect()
    assert [(e.source_table, e.status) for e in events] == [
        ("secprd2020", "started"), ("secprd2020", "complete"), ("secprd2021", "started"), ("secprd2021", "failed")]
    assert loader.read_target(plan[0]).count() == 2

    with pytest.raises(ValueError, match="holds rows of secprd2020"):
        loader.load(plan, read, resume=False)
    assert loader.clear_failed(plan) == ["secprd"]
    assert loader.clear_failed(plan) == []
    done = loader.load(plan, lambda p: prices(spark, p.source_year))
    assert done == [("secprd2020", "secprd", 0), ("secprd2021", "secprd", 2), ("secprd2022", "secprd", 2)]
    years = loader.read_target(plan[0]).groupBy("source_year").count().orderBy("source_year").collect()
    assert [tuple(r) for r in years] == [(2020, 2), (2021, 2), (2022, 2)]
    summary = loader.year_summary().orderBy("source_year").collect()
    assert [(r.source_year, r.rows_inserted, r.target_row_count) for r in summary] == [(2020, 2, 2), (2021, 2, 2), (2022, 2, 2)]


def test_clear_drops_only_the_failed_year(spark, tmp_path):
    loader = L.Loader(spark, str(tmp_path))
    plan = P.build_plan(price_years=[2020, 2021])
    loader.create_targets(plan)
    loader.load(plan, lambda p: prices(spark, p.source_year))
    loader.audit(plan[1], 0, datetime.now(UTC), "interrupted", "KeyboardInterrupt")
    assert loader.clear_failed(plan) == ["secprd"]
    assert [r.source_year for r in loader.read_target(plan[0]).select("source_year").distinct().collect()] == [2020]


def test_option_tables_by_month(spark, tmp_path):
    loader = L.Loader(spark, str(tmp_path))
    plan = P.build_plan(option_years=[2024])
    loader.create_targets(plan)
    df = spark.createDataFrame(
        [(2.0, "2024-02-01", "C", 0.5), (1.0, "2024-01-02", None, 0.1), (3.0, None, "P", None)],
        "secid double, date string, cp_flag string, delta double",
    )
    df = whole(df, "opprcd")
    assert loader.load(plan, lambda p: df) == [("opprcd2024", "opprcd2024", 3)]
    got = loader.read_target(plan[0]).select("month", "secid").orderBy("month").collect()
    assert [tuple(r) for r in got] == [("197001", 3), ("202401", 1), ("202402", 2)]
    loader.audit(plan[0], 0, datetime.now(UTC), "failed")
    loader.clear_failed(plan)
    assert loader.read_target(plan[0]).isEmpty()
    loader.require_empty(plan[0])


def test_plan_order_and_targets():
    plan = P.build_plan([("optionm_all", "securd", "securd")], [2020, 2021], [2021])
    assert [p.source_table for p in plan] == ["securd", "secprd2020", "secprd2021", "opprcd2021"]
    assert P.target_tables(plan) == ["securd", "secprd", "opprcd2021"]
    assert [p.year_slice for p in plan] == [None, 2020, 2021, None]
    with pytest.raises(ValueError):
        P.build_plan([("optionm_all", "zerocd", "zerocd")])


def test_audit_log_reading(spark, tmp_path):
    assert read_audit(spark, str(tmp_path / "none")).count() == 0
    log = tmp_path / "log.json"
    line = '{"source_library":"l","source_table":"t","target_table":"g","status":"%s","completed_at":"2024-01-01T00:00:0%d+00:00"}'
    log.write_text(line % ("started", 1) + "\n\n" + line % ("complete", 1) + "\n")
    assert [r.status for r in latest_status(read_audit(spark, str(log))).collect()] == ["complete"]
    log.write_text("not json\n")
    with pytest.raises(Exception):
        read_audit(spark, str(log)).collect()
    assert spark.createDataFrame([], AUDIT_SCHEMA).columns[5] == "status"


def test_replace_resume_refuse(spark, tmp_path):
    root, two = str(tmp_path), spark.range(2)
    assert L.load_file_tables(spark, [("t", two)], root).first().status == "loaded"
    assert L.load_file_tables(spark, [("t", two)], root, resume=True).first().status == "skipped"
    with pytest.raises(ValueError, match="holds 2 rows"):
        L.load_file_tables(spark, [("t", spark.range(3))], root, resume=True)
    replaced = L.load_file_tables(spark, [("t", spark.range(3))], root, replace=True, resume=True).first()
    assert (replaced.status, replaced.target_rows) == ("loaded", 3)
    with pytest.raises(ValueError, match="holds rows"):
        L.create_empty_tables(spark, [("t", two)], root)
    assert L.create_empty_tables(spark, [("t", two)], root, replace=True).first().status == "created-empty"
    assert L.create_empty_tables(spark, [("t", two)], root).first().status == "already-empty"


def test_replaced_partitions_leave_nothing_behind(spark, tmp_path):
    path, layout = str(tmp_path / "p"), LAYOUTS["secprd"]
    df = spark.createDataFrame([(2020, 1, None), (2021, 2, None)], "source_year smallint, secid bigint, date date")
    assert write_layout(df, path, layout) == 2
    assert write_layout(df.where("source_year = 2021"), path, layout, mode="overwrite") == 1
    assert [r.source_year for r in spark.read.parquet(path).collect()] == [2021]


def test_export_resume_preview_and_corrupt_target(spark, tmp_path):
    folder = str(tmp_path)
    schema = T.StructType.fromDDL("name string, d date")
    df = spark.createDataFrame([("alpha", "2020-01-01"), ("beta", "9000-01-01")], "name string, d string")
    (tmp_path / "lib__broken.parquet").write_bytes(b"not-a-real-parquet-file")
    assert E.export_table(df, folder, "lib", "broken", schema, resume=True) == 2
    assert E.export_table(df, folder, "lib", "broken", schema, resume=True) == 0
    assert E.export_table(df.where("false"), folder, "lib", "empty", schema, preview_rows=1) == 0
    assert E.export_table(df, folder, "lib", "shown", preview_rows=1) == 2
    assert spark.read.option("header", True).csv(f"{folder}/lib__shown__sample.csv").count() == 1
    assert spark.read.parquet(f"{folder}/lib__empty.parquet").schema["d"].dataType == T.DateType()
    (tmp_path / "ignore.txt").write_text("x")
    got = [tuple(r) for r in discover_tables(spark, folder).orderBy("table_name").collect()]
    assert got == [("lib__broken", 2), ("lib__empty", 0), ("lib__shown", 2)]


def test_failed_export_leaves_no_output(spark, tmp_path):
    df = spark.createDataFrame([("x",)], "d string")
    with pytest.raises(Exception, match="does not fit date"):
        E.export_table(df, str(tmp_path), "lib", "bad", T.StructType.fromDDL("d date"))
    assert not E.is_complete(spark, E.output_path(str(tmp_path), "lib", "bad"))


def test_discovery_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no .parquet files"):
        discover_tables(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError, match="does not exist"):
        discover_tables(spark, str(tmp_path / "none"))


def test_scan_sample_and_csv(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(30).withColumn("x", F.col("id") * 2).write.parquet(path)
    assert scan(spark, path, ["x"]).columns == ["x"]
    with pytest.raises(ValueError, match="no columns requested"):
        scan(spark, path, [])
    assert [r.id for r in sample_rows(spark.read.parquet(path), 3, ["id"]).collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        sample_rows(spark.range(1), 0)
    written = E.export_samples(spark, [("lib", "t", spark.range(30))], str(tmp_path / "samples"), 10)
    assert read_csv(spark, written[0], "id bigint").count() == 10
    assert distinct_library_names([" a", "b", "a ", " "]) == ["a", "b"]
    with pytest.raises(ValueError):
        distinct_library_names([" "])


def test_export_rewrites_broken_output_and_keeps_the_old_one_on_failure(spark, tmp_path):
    folder = str(tmp_path)
    assert E.export_table(spark.range(10), folder, "l", "t") == 10
    path = E.output_path(folder, "l", "t")
    assert E.export_table(spark.range(10), folder, "l", "t", resume=True) == 0
    failing = spark.range(10).select(F.raise_error(F.lit("broken source")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken source"):
        E.export_table(failing, folder, "l", "t")
    assert spark.read.parquet(path).count() == 10
    part = next((tmp_path / "l__t.parquet").glob("part-*.parquet"))
    for crc in (tmp_path / "l__t.parquet").glob(".part-*.crc"):
        crc.unlink()
    part.write_bytes(b"garbage")
    assert not E.is_complete(spark, path)
    assert E.export_table(spark.range(10), folder, "l", "t", resume=True) == 10
    assert sorted(p.name for p in tmp_path.iterdir()) == ["l__t.parquet"]


def test_resume_notices_other_content(spark, tmp_path):
    root = str(tmp_path / "tables")
    rows = [(1, "a", None), (2, None, 1.5), (2, None, 1.5)]
    schema = "k long, s string, x double"
    table = spark.createDataFrame(rows, schema)
    L.load_file_tables(spark, [("t", table)], root)
    again = lambda r: L.load_file_tables(spark, [("t", spark.createDataFrame(r, schema))], root, resume=True).first().status
    assert again(rows[::-1]) == "skipped"  # order does not matter
    assert again([(1, None, 1.5), (2, None, 1.5), (2, "a", None)]) == "reloaded"
    assert sorted(r.k for r in spark.read.parquet(f"{root}/t").collect()) == [1, 2, 2]
    assert again([(1, None, 1.5), (1, None, 1.5), (2, "a", None)]) == "reloaded"  # copies count
    assert again([(1, None, 1.5), (1, None, 1.5), (2, "a", None)]) == "skipped"


def test_a_target_without_a_record_is_read(spark, tmp_path):
    root = str(tmp_path / "tables")
    spark.range(5).write.parquet(f"{root}/t")
    assert L.load_file_tables(spark, [("t", spark.range(5))], root, resume=True).first().status == "skipped"
    assert L.load_file_tables(spark, [("t", spark.range(1, 6))], root, resume=True).first().status == "reloaded"


def test_outputs_are_checked_together(spark, tmp_path):
    def jobs(folder):
        group = f"jobs-{folder}"
        spark.sparkContext.setJobGroup(group, group)
        found = {r.table_name for r in E.completed_outputs(spark, folder).collect()}
        count = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found, count

    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    for folder, n in ((few, 3), (many, 12)):
        for i in range(n):
            E.export_table(spark.range(20 if i else 0).repartition(2), folder, "lib", f"t{i}")
    sound, count = jobs(few)
    assert sound == {"t0", "t1", "t2"}  # t0 has no rows
    # Cut one file short, put text in place of another, take a marker away.
    parts = lambda t: sorted((tmp_path / "many" / f"lib__{t}.parquet").glob("part-*"))
    for file in (tmp_path / "many").rglob(".*.crc"):
        file.unlink()
    parts("t3")[0].write_bytes(parts("t3")[0].read_bytes()[:-9])
    parts("t4")[0].write_text("n" * 5000)
    parts("t0")[0].write_bytes(b"PAR1" + b"x" * 40 + b"PAR1")
    (tmp_path / "many" / "lib__t5.parquet" / "_SUCCESS").unlink()
    found, more = jobs(many)
    assert found == {f"t{i}" for i in range(12)} - {"t0", "t3", "t4", "t5"}
    assert more <= count + 1
    assert E.completed_outputs(spark, str(tmp_path / "none")).collect() == []
