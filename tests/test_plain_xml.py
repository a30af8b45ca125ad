"""Holdings documents read many at once, beside the full parser."""

import pyarrow as pa
from pyspark.sql import functions as F

from panelforge.functions.plain_xml import Layout, read_plain
from panelforge.operators import filings as H

LAYOUT = Layout("infoTable", [(parent, element) for _, parent, element in H.HOLDING_FIELDS])
PLAIN = [
    "<x><infoTable><value>1</value></infoTable></x>",
    '<?xml version="1.0" encoding="UTF-8"?>\n<n:x xmlns:n="u" xmlns:s="v" s:l="a b">\n <n:infoTable>\n  <n:nameOfIssuer>　A &amp; B\xa0</n:nameOfIssuer>\n'
    "  <n:value/><n:shrsOrPrnAmt><n:sshPrnamt>5</n:sshPrnamt> </n:shrsOrPrnAmt><n:w><n:cusip>no</n:cusip></n:w></n:infoTable>\n</n:x>\n",
    "<x><other>t</other><infoTable><sshPrnamt>9</sshPrnamt><Sole>&amp;lt;</Sole><value>2</value></infoTable><infoTable><cusip>é  c</cusip></infoTable></x>",
]
ODD = [
    "<x><infoTable><value>1</value><value>2</value></infoTable></x>",
    "<x><infoTable><value><![CDATA[<]]></value></infoTable></x>",
    "<x><infoTable><value>1<!-- c -->2</value></infoTable></x>",
    "<x><infoTable><value>&#49;</value></infoTable></x>",
    "<x><infoTable><value>a<b>c</b></value></infoTable></x>",
    "<x><infoTable id='1'><Value>1</Value></infoTable></x>",
    "<x><infoTable><value a='>'>1</value></infoTable></x>",
    "<x>loose<infoTable><value>1</value></infoTable></x>",
    "<x><infoTable><votingAuthority/><Sole>1</Sole></infoTable><infoTable/></x>",
    "<x></x>",
    " <x><infoTable><cusip>1</cusip></infoTable></x>",
]
MALFORMED = [
    "", "x", "<x><infoTable><value>1</cusip></infoTable></x>", "<x><infoTable></x>", "<x><infoTable><value>1</infoTable></value></x>",
    "<x><infoTable><value>1 & 2</value></infoTable></x>", "<x><infoTable><value>1\x01</value></infoTable></x>", "<x><infoTable/>",
    '<x a="1" a="2"><infoTable><value>1</value></infoTable></x>', "<x><infoTable><value>&nbsp;</value></infoTable></x>",
    "<x><infoTable><val ue>1</val ue></infoTable></x>", "<x><infoTable><value>1</value></infoTable></x", "<><infoTable><value>1</value></infoTable></>",
]


def test_only_plain_documents_are_taken():
    docs = [None, *MALFORMED, *PLAIN, *ODD, *PLAIN]
    others, document, position, columns = read_plain(pa.array(docs, pa.string()), LAYOUT)
    assert sorted(docs[i] for i in others) == sorted(MALFORMED + ODD)
    assert [docs[i] for i in document] == [d for d in PLAIN * 2 for _ in range(d.count("infoTable>") // 2)]
    assert position.tolist() == [0, 0, 0, 1] * 2
    found = dict(zip((name for name, _, _ in H.HOLDING_FIELDS), (c.to_pylist() for c in columns)))
    assert found["name_of_issuer"] == ["", "A & B", "", ""] * 2 and found["value"] == ["1", "", "2", ""] * 2
    assert found["ssh_prnamt"] == ["", "5", "9", ""] * 2 and found["voting_authority_sole"] == ["", "", "&lt;", ""] * 2
    assert found["cusip"] == ["", "", "", "é  c"] * 2


def test_slices_and_wide_columns():
    for kind in (pa.string(), pa.large_string()):
        part = pa.array([None, *ODD, *PLAIN, None, *PLAIN], kind).slice(len(ODD), 5)
        others, document, position, columns = read_plain(part, LAYOUT)
        assert others.tolist() == [0] and document.tolist() == [1, 2, 3, 3] and position.tolist() == [0, 0, 0, 1]
    assert [len(x) for x in read_plain(pa.array([], pa.string()), LAYOUT)[:3]] == [0, 0, 0]


def test_rows_are_those_of_the_full_parser(spark):
    docs = spark.createDataFrame([(i, d) for i, d in enumerate([None, *PLAIN, *ODD] * 3)], "id int, xml string")
    parsed = docs.select("id", F.from_xml("xml", H.holding_schema(), {"ignoreNamespace": "true", "mode": "FAILFAST"}).alias("d"))
    rows = parsed.select("id", F.posexplode_outer("d.infoTable").alias("position", "h")).where("position is not null")
    expected = rows.select("id", "position", *H._fields(F.col("h")))
    got = H.flatten_holdings(docs, ["id"])
    assert got.dtypes == expected.dtypes and sorted(got.collect()) == sorted(expected.collect())


def test_every_malformed_document_fails(spark):
    import pytest

    for d in MALFORMED:
        docs = spark.createDataFrame([(1, PLAIN[0]), (2, d)], "id int, xml string").coalesce(1)
        with pytest.raises(Exception):
            H.flatten_holdings(docs, ["id"], columns=["value"]).collect()


def test_rendered_documents(spark, tmp_path):
    """Entries count down to a line number below 1; a null part or quantity leaves none, a null line no document."""

    from panelforge.suite.common import Tables
    from panelforge.suite.filing_queries import holding_documents

    rows = [(1, 2, 1234, 7, 5.0, "A"), (2, 3, 45, 7, 5.0, "N"), (3, 0, 7, 7, 5.0, None), (4, 1, None, 7, 5.0, "R"), (5, 1, 7, 7, None, "X"), (6, None, 7, 7, 5.0, "A"), (7, 1, 7, 7, 5.0, "X")]
    spark.createDataFrame(
        rows, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_returnflag string"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    docs = holding_documents(Tables(spark, str(tmp_path)))
    found = {r.l_orderkey: r.xml for r in docs.collect()}
    head, root = '<?xml version="1.0"?>', '<informationTable xmlns="urn:holdings">'
    assert found[4] == found[5] == f"{head}{root}</informationTable>" and found[6] is None

    def entry(i, value, part, amount, put):
        return (
            f"<infoTable><nameOfIssuer> Issuer {part} &amp; Co </nameOfIssuer><cusip>{part:09d}</cusip><value>{value}</value>{amount}{put}"
            f"<votingAuthority><Sole>{i}</Sole><None>0</None></votingAuthority></infoTable>"
        )

    def amount(n):
        return f"<sshPrnamt>{n}</sshPrnamt><sshPrnamtType>SH</sshPrnamtType>"

    put = "<putCall>Put</putCall>"
    bare = "".join(entry(i, v, 45, amount(5 + i), put) for i, v in ((1, "1045"), (2, "2,045"), (3, "")))
    assert found[2] == f"{head}{root}{bare}</informationTable>"
    grouped = {n: f"<shrsOrPrnAmt>{amount(n)}</shrsOrPrnAmt>" for n in (5, 6, 7)}
    assert found[3] == f"{head}{root}{entry(1, '1007', 7, grouped[6], '')}{entry(0, '0,007', 7, grouped[5], '')}</informationTable>"
    assert found[7] == f"{head}{root}{entry(1, '1007', 7, grouped[6], put)}</informationTable>"
    both = entry(1, "1234", 1234, grouped[6], put) + entry(2, "2,234", 1234, grouped[7], put)
    assert found[1] == f'{head}<n1:informationTable xmlns:n1="urn:holdings">' + both.replace("</", "</n1:").replace("<", "<n1:").replace("<n1:/n1:", "</n1:") + "</n1:informationTable>"
