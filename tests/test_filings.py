"""Holdings documents and submission feeds."""

import json

import pytest
from pyspark.sql import functions as F

from panelforge.operators import filings as H
from panelforge.sinks.exports import write_holdings_csv
from panelforge.sources.documents import read_documents, read_submissions

PREFIXED = """<?xml version="1.0"?>
<n1:informationTable xmlns:n1="u"><n1:infoTable><n1:nameOfIssuer> A &amp; B </n1:nameOfIssuer><n1:value>1,000</n1:value>
<n1:cusip>first</n1:cusip><n1:cusip>second</n1:cusip>
<n1:shrsOrPrnAmt><n1:sshPrnamt>5</n1:sshPrnamt><n1:sshPrnamtType>SH</n1:sshPrnamtType></n1:shrsOrPrnAmt>
<n1:votingAuthority><n1:Sole>5</n1:Sole><n1:Shared>0</n1:Shared><n1:None>0</n1:None></n1:votingAuthority></n1:infoTable>
<n1:other/><n1:infoTable><n1:sshPrnamt>9</n1:sshPrnamt><n1:Sole>3</n1:Sole><n1:value></n1:value></n1:infoTable></n1:informationTable>"""


def test_flatten(spark):
    plain = PREFIXED.replace("n1:", "").replace(":n1", "")
    docs = spark.createDataFrame([(1, PREFIXED), (2, plain), (3, "<informationTable/>")], "id int, xml string")
    rows = H.flatten_holdings(docs, ["id"]).orderBy("id", "position").collect()
    assert [(r.id, r.position) for r in rows] == [(1, 0), (1, 1), (2, 0), (2, 1)]
    for first, second in ((rows[0], rows[1]), (rows[2], rows[3])):
        assert (first.name_of_issuer, first.cusip, first.ssh_prnamt, first.voting_authority_sole) == ("A & B", "first", "5", "5")
        assert (second.ssh_prnamt, second.voting_authority_sole, second.value, second.put_call) == ("9", "3", "", "")


def test_malformed_document_fails(spark):
    docs = spark.createDataFrame([(1, "<informationTable><infoTable>")], "id int, xml string")
    with pytest.raises(Exception):
        H.flatten_holdings(docs, ["id"]).collect()


def test_value_order(spark):
    rows = [(0, "5"), (1, ""), (2, "1,000"), (3, "5")]
    df = spark.createDataFrame([(1, p, v) for p, v in rows], "id int, position int, value string")
    assert [r.position for r in H.holdings_by_value(df, ["id"]).collect()] == [2, 0, 3, 1]
    assert [r.position for r in H.holdings_preview(df, ["id"], 2).orderBy("value_rank").collect()] == [2, 0]
    with pytest.raises(Exception, match="holding value is not a number"):
        df.select(H.holding_value(F.lit("12.5"))).collect()


def test_value_is_a_number_before_the_sort(spark):
    """No comparison of the sort works the number out again; every spelling keeps its value and its place."""

    texts = ["7", "1,000", "", " +1_0 ", "-3", "9" * 18, "9" * 19, "9" * 38, "007", "5\n", "0", "-0"]
    numbers = [7, 1000, -1, 10, -3, 10**18 - 1, 10**19 - 1, 10**38 - 1, 7, 5, 0, 0]
    df = spark.createDataFrame([(1, t, i) for i, t in enumerate(texts)], "id int, value string, position int")
    ordered = H.holdings_by_value(df, ["id"])
    sort = next(line for line in ordered._jdf.queryExecution().toString().split("== Physical Plan ==")[1].splitlines() if "Sort [" in line)
    assert "replace" not in sort and "RLIKE" not in sort.upper()
    assert ordered.columns == df.columns
    expected = sorted(range(len(texts)), key=lambda i: (-numbers[i], i))
    assert [r.position for r in ordered.collect()] == expected
    valued = df.withColumn("amount", H.holding_value(F.col("value")))
    assert [int(r.amount) for r in valued.orderBy("position").collect()] == numbers
    assert [r.position for r in H.holdings_by_value(valued, ["id"], "amount").collect()] == expected


def test_preview_of_large_values(spark):
    """Values beyond 64 bits keep their order among themselves and around the others."""

    texts = ["5", "9" * 38, "-" + "9" * 38, "9" * 19, "9" * 20, "-" + "9" * 19, str(1 << 62), "4", "5"]
    df = spark.createDataFrame([(1, t, i) for i, t in enumerate(texts)], "id int, value string, position int")
    rows = H.holdings_preview(df, ["id"], 8).orderBy("value_rank").collect()
    assert [r.position for r in rows] == sorted(range(len(texts)), key=lambda i: (-int(texts[i]), i))[:8]
    assert df.columns + ["value_rank"] == H.holdings_preview(df, ["id"], 8).columns


def test_filers_meet_in_a_task_before_the_cut(spark, tmp_path, monkeypatch):
    """Nearly every filer has its documents in one task; a crowded one is cut, and the top 25 stay those of all its documents."""

    from panelforge.suite import filing_queries as Q
    from panelforge.suite.common import Tables

    rows = [(i, 1, i * 37 % 1000, i % 60 if i % 3 else 7, 1.0, "N") for i in range(3000)]
    spark.createDataFrame(
        rows, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_returnflag string"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(Q, "ROWS_BY_FILER", 100)
    t = Tables(spark, str(tmp_path))
    pairs = Q.holding_documents(t, by_filer=True).select("l_suppkey", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(pairs) <= 60 + 30 and sum(r.l_suppkey == 7 for r in pairs) > 5
    got = {}
    for r in Q.holdings_top25(t).orderBy("l_suppkey", "value_rank").collect():
        got.setdefault(r.l_suppkey, []).append(r.l_orderkey)
    docs = {}
    for order, _, part, filer, _, _ in rows:
        docs.setdefault(filer, []).append((-(1000 + part), order))
    assert got == {filer: [order for _, order in sorted(found)[:25]] for filer, found in docs.items()}


def test_latest_filing_and_document(spark, tmp_path):
    feed = {"cik": "1067983", "filings": {"recent": {
        "form": ["4", "13F-HR/A", "13F-HR"], "accessionNumber": ["1-1-1", "0001-24-02", "x"],
        "primaryDocument": ["a", "b.xml", "c"], "filingDate": ["2024-01-01", "2024-02-02", "2024-03-03"]}}}
    (tmp_path / "one.json").write_text(json.dumps(feed))
    feed["cik"], feed["filings"]["recent"]["form"] = "5", ["4", "4", "4"]
    (tmp_path / "two.json").write_text(json.dumps(feed))
    rows = {r.cik: r for r in H.latest_filing(read_submissions(spark, str(tmp_path))).collect()}
    hit = rows["1067983"]
    assert (hit.padded_cik, hit.filing_type, hit.accession_number, hit.error) == ("0001067983", "13F-HR/A", "0001-24-02", None)
    assert hit.filing_directory_url.endswith("/data/1067983/00012402")
    assert rows["5"].error == "No public 13F filing found for CIK 5" and rows["5"].accession_number is None


def test_document_choice(spark):
    other, holdings = "<x/>", "<?xml version='1.0'?>\n<!-- c --><a:informationTable xmlns:a='u'/>"
    rows = [
        ("1", "p.xml", ["p.xml", "one.XML", "n.txt"], [holdings, other, "t"]),
        ("2", "p.xml", ["a.xml", "b.xml"], [other, holdings]),
        ("3", "p.xml", ["a.xml", "b.xml"], [other, other]),
        ("4", "p.xml", ["p.xml"], [holdings]),
    ]
    df = spark.createDataFrame(rows, "cik string, primary_document string, names array<string>, documents array<string>")
    got = {r.cik: r.document_name for r in H.holdings_document(df, ["cik"]).collect()}
    assert got == {"1": "one.XML", "2": "b.xml", "3": None, "4": None}


def test_whole_documents_and_empty_csv(spark, tmp_path):
    (tmp_path / "d.xml").write_text(PREFIXED)
    docs = read_documents(spark, str(tmp_path))
    flat = H.flatten_holdings(docs, ["file_name"])
    assert flat.count() == 2
    write_holdings_csv(flat, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2
    with pytest.raises(ValueError, match="no rows to write"):
        write_holdings_csv(flat.where("false"), str(tmp_path / "none"))


def test_long_ids_stay_whole(spark):
    from panelforge.functions.text import padded_cik

    df = spark.createDataFrame([("12345678901",), ("7",)], "cik string")
    assert [r[0] for r in df.select(padded_cik(df.cik)).collect()] == ["12345678901", "0000000007"]


def test_documents_are_cut_while_they_are_read(spark, tmp_path):
    """One large document over many file splits, a malformed holding, a cut document, attributes and prefixes."""

    from panelforge.sources.documents import read_holding_records

    one = "<ns:infoTable><ns:nameOfIssuer>A &amp; {}</ns:nameOfIssuer>\n<shrsOrPrnAmt><sshPrnamt>{}</sshPrnamt></shrsOrPrnAmt></ns:infoTable>\n"
    (tmp_path / "large.xml").write_text('<x xmlns:ns="u">' + "".join(one.format(i, i * 2) for i in range(3000)) + "</x>")
    (tmp_path / "bad.xml").write_text(
        "<x><infoTable><value>1</value></infoTable><infoTable><value>2</cusip></infoTable>\n<infoTable id='3'><value>3</value></infoTable></x>"
    )
    (tmp_path / "cut.xml").write_text("<x><infoTable><value>1</value></infoTable><infoTable><value>2</val")
    (tmp_path / "none.xml").write_text("<x></x>")
    (tmp_path / "empty.xml").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        records = read_holding_records(spark, str(tmp_path))
        rows = H.parse_holdings(records, ["file_name"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    large = sorted((r for r in rows if r.file_name == "large.xml"), key=lambda r: r.position)
    assert [(r.position, r.name_of_issuer, r.ssh_prnamt, r.corrupt_record) for r in large] == [
        (i, f"A & {i}", str(i * 2), None) for i in range(3000)
    ]
    bad = sorted((r.position, r.value, r.corrupt_record is not None) for r in rows if r.file_name == "bad.xml")
    assert bad == [(0, "1", False), (1, None, True), (2, "3", False)]
    cut = sorted((r.position, r.value, r.corrupt_record) for r in rows if r.file_name == "cut.xml")
    assert cut == [(0, "1", None), (1, None, "<value>2</val")]
    assert {r.file_name for r in rows} == {"large.xml", "bad.xml", "cut.xml"}


def test_a_cut_holding_is_found_wherever_a_split_begins(spark, tmp_path):
    from panelforge.sources.documents import read_holding_records

    text = "<x>" + "<infoTable><value>1</value></infoTable>" * 12 + "<infoTable><value>2</val"
    (tmp_path / "cut.xml").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (19, 41, 64, 97):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            rows = sorted((r.position, r.closed) for r in read_holding_records(spark, str(tmp_path)).collect())
            assert rows == [(i, i < 12) for i in range(13)], size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_are_landed_by_tasks(spark, monkeypatch):
    """The driver moves no file; rows of one name share a file, a missing text is an empty line."""

    from panelforge.suite import filing_queries as Q
    from panelforge.suite.common import Tables

    monkeypatch.setattr(Q, "rename_path", None)
    rows = [(f"d{i}.txt", f"text {i}") for i in range(50)] + [("d7.txt", "text 7"), ("none.txt", None)]
    folder = Q.landed(Tables(spark, "unused"), spark.createDataFrame(rows, "name string, text string"), "name", "text")
    found = {r.file_name: r.xml for r in read_documents(spark, folder, "*.txt").collect()}
    assert found == {f"d{i}.txt": f"text {i}\n" for i in range(50)} | {"d7.txt": "text 7\ntext 7\n", "none.txt": "\n"}


def test_only_wanted_fields_are_parsed(spark):
    """The schema of the parse has the wanted fields alone; rows and failures stay those of the whole parse."""

    assert H.holding_schema([H.HOLDING_FIELDS[2]]) == "infoTable array<struct<`cusip`: array<string>>>"
    docs = spark.createDataFrame([(1, PREFIXED), (2, "<informationTable/>")], "id int, xml string")
    whole = H.flatten_holdings(docs, ["id"])
    for columns in ([], ["cusip"], ["value", "ssh_prnamt", "voting_authority_sole"]):
        some = H.flatten_holdings(docs, ["id"], columns=columns)
        names = ["id", "position", *[n for n, _, _ in H.HOLDING_FIELDS if n in columns]]
        assert some.columns == names
        assert sorted(some.collect()) == sorted(whole.select(*names).collect())
    bad = spark.createDataFrame([(1, "<informationTable><infoTable><value>1</cusip></infoTable></informationTable>")], "id int, xml string")
    with pytest.raises(Exception):
        H.flatten_holdings(bad, ["id"], columns=[]).collect()
