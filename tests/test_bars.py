"""Bar files: reading, line numbers, parsing, issues."""

from datetime import datetime

import pytest

from panelforge.operators import bars as B
from panelforge.sinks.bar_loads import check_folder, load_bars
from panelforge.sinks.exports import write_rejects
from panelforge.sources.bar_files import number_lines, numbered_bar_lines, read_bar_lines


def lines(spark, *texts, name="SNT_full_1min.txt"):
    return spark.createDataFrame([(name, i, t) for i, t in enumerate(texts, 1)], "file_name string, line_number int, line string")


@pytest.mark.parametrize(
    "name,symbol",
    [("SNT_full_1min.txt", "SNT"), ("bns_full_1min_adjsplitdiv.txt", "BNS"), ("ER_U24_1min.txt", "ER_U24"),
     ("X.txt", None), ("_1min.txt", None), ("a_full_1min_b_1min.txt", "A"), ("a.b_1min.txt", "A.B")],
)
def test_symbol(spark, name, symbol):
    df = spark.createDataFrame([(name,)], "f string")
    assert df.select(B.symbol_of(df.f).alias("s")).first().s == symbol


def test_parse_accepts_and_rejects(spark):
    good = "2024-1-2 3:04:05, 1.5 ,nan,-2,1_0,7"
    df = lines(
        spark, good, "", "2024-01-02 09:30:00,1,1,1,1", "bad,1,1,1,1,1", "2024-01-02 09:30:00,1,1,1,1,inf",
        "2024-01-02 09:30:00,1d,1,1,1,1", '2024-01-02 09:30:00,"1","2",1,1,1', '"x,y",1,1,1,1,1', " ",
        " 2024-01-02 09:30:00,1,1,1,1,1",
    )
    parsed = B.parse_bars(df)
    rows = {r.line_number: r for r in parsed.collect()}
    assert set(rows) == {1, 3, 4, 5, 6, 7, 8, 9, 10}
    first = rows[1]
    assert first.error is None and first.local_ts == datetime(2024, 1, 2, 3, 4, 5)
    assert (first.open, str(first.high), first.low, first.close, first.volume) == (1.5, "nan", -2.0, 10.0, 7.0)
    assert first.negatives == ["low"]
    assert rows[7].error is None and (rows[7].open, rows[7].high) == (1.0, 2.0)
    assert rows[3].error == "SNT_full_1min.txt:3 expected 6 columns, got 5"
    assert rows[9].error.endswith("got 1") and "timestamp" in rows[8].error and "timestamp" in rows[10].error
    assert "volume must be a finite" in rows[5].error and "open must be a numeric" in rows[6].error
    assert B.rejects(parsed).count() == 7


def test_clock_changes_and_utc_symbols(spark):
    df = lines(spark, *[f"{t},1,1,1,1,1" for t in ("2024-03-10 02:30:00", "2024-11-03 01:30:00", "2024-07-01 09:30:00")])
    got = [r.ts.isoformat(" ") for r in B.good_bars(B.parse_bars(df), "America/New_York").collect()]
    assert got == ["2024-03-10 07:30:00", "2024-11-03 05:30:00", "2024-07-01 13:30:00"]
    kept = B.good_bars(B.parse_bars(df), "America/New_York", [" snt "]).collect()
    assert kept[2].ts == datetime(2024, 7, 1, 9, 30)


def test_all_issues_of_a_line(spark):
    df = lines(spark, " ,x,-1,inf,nan, ", "1,2", "2024-01-02 09:30:00,1,1,1,1,1")
    got = sorted((r.line_number, r.column_name, r.issue) for r in B.line_issues(df).collect())
    assert got == [
        (1, "close", "non-finite"), (1, "high", "negative"), (1, "low", "non-finite"), (1, "open", "non-numeric"),
        (1, "timestamp", "empty"), (1, "volume", "empty"), (2, "", "wrong column count: expected 6, got 2"),
    ]


def test_report_lists_clean_files(spark):
    df = lines(spark, ",1,1,1,1,1", name="BNS_full_1min.txt").unionByName(lines(spark, "2024-01-02 09:30:00,1,1,1,1,1"))
    got = sorted(tuple(r) for r in B.file_report(df, B.line_issues(df)).collect())
    assert got == [("BNS_full_1min.txt", 1, "issues found"), ("SNT_full_1min.txt", 0, "OK")]


def test_last_field_max(spark):
    df = lines(spark, "a,1", "b,nan", "c, 5 ", "d,x", "7", "").unionByName(lines(spark, "x", "-inf", name="B_1min.txt"))
    got = {r.file_name: r.max_last_field for r in B.last_field_max(df).collect()}
    assert got == {"SNT_full_1min.txt": 7.0, "B_1min.txt": None}


def test_line_numbers_across_splits(spark, tmp_path):
    for name, n in (("SNT_full_1min.txt", 3000), ("ER_U24_1min.txt", 40)):
        body = "".join(f"2024-01-02 09:30:00,1,1,1,1,{i}\n" if i % 7 else "\n" for i in range(1, n + 1))
        (tmp_path / name).write_text(body)
    (tmp_path / "notes.txt").write_text("ignored\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        rows = numbered_bar_lines(spark, str(tmp_path)).collect()
        numbered = {(r.file_name, r.line_number): r.line for r in rows}
        assert len(numbered) == len(rows) == 3040
        assert all(line == "" if i % 7 == 0 else line.endswith(f",{i}") for (_, i), line in numbered.items())
        raw = read_bar_lines(spark, str(tmp_path))
        some = number_lines(raw, raw.where(raw.line.endswith(",2999"))).collect()
        assert [(r.file_name, r.line_number) for r in some] == [("SNT_full_1min.txt", 2999)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_rejects_are_appended(spark, tmp_path):
    rejected = B.rejects(B.parse_bars(lines(spark, "1,2")))
    path = str(tmp_path / "rejects")
    write_rejects(rejected, path)
    write_rejects(rejected, path)
    assert spark.read.json(path).count() == 2


def test_folder_load_and_check(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    with pytest.raises(FileNotFoundError):
        load_bars(spark, str(folder), str(tmp_path / "t"), str(tmp_path / "r"))
    (folder / "BNS_full_1min_adj.txt").write_text("2024-01-02 09:30:00,1,1,1,1,1\n\n,1,1,1,1,1\n2024-02-02 09:30:00,1,1,1,-1,1\n")
    (folder / "ER_U24_1min.txt").write_text("2024-01-02 09:30:00,1,1,1,1,1\n")
    (folder / "EMPTY_1min.txt").write_text("")
    target, bad = str(tmp_path / "t"), str(tmp_path / "r")
    assert load_bars(spark, str(folder), target, bad, utc_symbols=["er_u24"]) == 3
    assert load_bars(spark, str(folder), target, bad, clean_start=True) == 3
    stored = spark.read.parquet(target)
    assert stored.count() == 3 and sorted(str(r.month) for r in stored.select("month").distinct().collect()) == ["202401", "202402"]
    errors = {(r.file_name, r.line_number, r.line) for r in spark.read.json(bad).collect()}
    assert errors == {("BNS_full_1min_adj.txt", 3, ",1,1,1,1,1")}
    report, issues = check_folder(spark, str(folder))
    assert sorted((r.file_name, r.issue_count, r.status) for r in report.collect()) == [
        ("BNS_full_1min_adj.txt", 2, "issues found"), ("EMPTY_1min.txt", 0, "OK"), ("ER_U24_1min.txt", 0, "OK")]
    assert sorted((r.line_number, r.column_name, r.issue) for r in issues.collect()) == [
        (3, "timestamp", "empty"), (4, "close", "negative")]


def test_bar_files_are_written_by_tasks(spark, tmp_path, monkeypatch):
    """The driver lists and renames no file; lines keep the order of their events."""

    from panelforge.sources import tables
    from panelforge.suite import bar_queries as Q
    from panelforge.suite.common import Tables

    for module in (Q, tables):
        monkeypatch.setattr(module, "rename_path", None, raising=False)
    spark.range(5000).selectExpr(
        "id AS event_id", "if(id % 2 = 0, 'click', 'purchase') AS event_type", "timestamp '2024-01-01 00:00:00' AS ts", "2.5D AS value"
    ).write.parquet(f"{tmp_path}/events.parquet")
    folder = Q.bar_folder(Tables(spark, str(tmp_path)))
    lines = spark.read.text(folder).selectExpr("_metadata.file_name AS f", "value")
    assert {r.f for r in lines.select("f").distinct().collect()} == {
        f"{kind}{i}_full_1min_adj.txt" for kind in ("click", "purchase") for i in range(3)
    }
    last = [r.value.rsplit(",", 1)[1] for r in lines.where("f = 'click1_full_1min_adj.txt'").collect() if r.value.count(",") == 5]
    ids = [int(v) for v in last if v.strip().isdigit()]
    assert ids == sorted(ids) and len(ids) > 800
