"""The post-load checklist on a small panel, and how often it scans the panel."""

from datetime import date

from panelforge.operators.checklist import daily_summary, post_load_checklist

PANEL = "secid long, date date, optionid long, exdate date, cp_flag string, strike_price double, open_interest long"
LINKS = "secid long, sdate date, edate date, permno long, score double"


def test_every_check(spark, tmp_path):
    d = [date(2000, 11, 27), date(2000, 11, 28), date(2000, 11, 30), date(2001, 1, 2)]
    rows = [
        (1, d[0], 7, d[3], "C", 5.0, 10), (1, d[0], 7, d[3], "C", 5.0, 11), (1, d[1], 7, d[3], "P", 5.0, 12),
        (2, d[2], 8, None, None, 5.0, 1), (1, d[3], 7, d[3], "C", None, 3), (None, d[3], 9, d[3], "C", 1.0, 1),
    ]
    spark.createDataFrame(rows, PANEL).write.parquet(str(tmp_path / "panel"))
    panel = spark.read.parquet(str(tmp_path / "panel"))
    links = spark.createDataFrame([(1, date(1996, 1, 1), date(2000, 12, 31), 10, 1.0), (1, d[0], d[0], 11, 2.0)], LINKS)
    expected = spark.createDataFrame([(2000, 4), (2001, 1), (2002, 0), (2003, 5)], "year int, row_count long")
    got = {(r.check_name, r.year): (r.value, r.status) for r in post_load_checklist(panel, links, expected, least_match=0.5).collect()}
    assert got["row_count", 2000] == ("4", "ok") and got["row_count", 2001] == ("2", "review")
    assert got["row_count", 2002] == ("0", "ok") and got["row_count", 2003] == ("0", "review")
    assert got["min_date", 2000] == ("2000-11-27", "ok") and got["max_date", 2001] == ("2001-01-02", "ok")
    assert got["link_match_rate", 2000] == ("0.75", "ok")  # two links on one day count once
    assert got["link_match_rate", 2001] == ("0.0", "review")
    assert got["duplicate_contract_date_keys", None] == ("1", "review")
    nulls = {k[0]: v for k, v in got.items() if k[0].startswith("null_")}
    assert nulls["null_secid"] == ("1", "review") and nulls["null_strike_price"] == ("1", "review") and nulls["null_date"] == ("0", "ok")
    assert nulls["null_exdate"] == nulls["null_cp_flag"] == ("1", "review")
    assert got["lag_available_same_day", None] == ("0.5", "ok")
    assert got["lag_available_lagged_by_source", None] == ("0.0", "review")


def test_the_panel_is_scanned_once(spark, tmp_path):
    rows = [(1, date(2000, 1, 3), 7, date(2000, 2, 1), "C", 5.0, 10)]
    spark.createDataFrame(rows, PANEL).write.parquet(str(tmp_path / "panel"))
    panel = spark.read.parquet(str(tmp_path / "panel"))
    group = "scans-of-the-panel"
    spark.sparkContext.setJobGroup(group, group)
    report = post_load_checklist(panel, spark.createDataFrame([], LINKS), year=panel["date"].substr(1, 4))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # What is returned reads the stored summary only.
    assert str(tmp_path / "panel") not in report._jdf.queryExecution().optimizedPlan().toString()
    assert not [f for f in report.inputFiles() if str(tmp_path / "panel") in f]
    assert {r.year for r in report.collect()} == {None, 2000}


def test_an_empty_panel(spark):
    empty = spark.createDataFrame([], PANEL)
    report = post_load_checklist(empty, spark.createDataFrame([], LINKS)).collect()
    assert {r.value for r in report} == {"0"} and {r.status for r in report} == {"ok"}
    assert daily_summary(empty, empty["secid"]).count() == 0
