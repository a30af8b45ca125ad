"""Holdings filings rendered from orders and line items.

A line item becomes one holdings document with as many entries as its line
number; an order becomes one submission feed and one filing directory. Nothing
is grouped to build them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators import filings as H
from panelforge.session import land, work_dir
from panelforge.sinks.exports import write_holdings_csv
from panelforge.sources.documents import read_documents, read_holding_records, read_submissions
from panelforge.sources.tables import entry_names, read_csv, rename_path
from panelforge.suite.common import Suite, Tables, number, spread

suite = Suite()


def padded(number: Column, width: int) -> Column:
    """Padded with zeros to ``width`` digits; longer numbers stay whole."""

    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))


# Rows of a task that takes documents by filer: the sample for their ranges, some 300 rows a task,
# stays small beside the driver.
ROWS_BY_FILER = 100_000


def holding_documents(t: Tables, by_filer: bool = False) -> DataFrame:
    """One XML document per line item.

    Entry i has value i * 1000 + part % 1000, written with a comma when i is
    even and left blank when i is 3. Flag A uses a namespace prefix, flag N has
    the amount directly under the holding, flag R has no put/call field.
    """

    flag, part, lines = F.col("l_returnflag"), F.col("l_partkey"), F.col("l_linenumber")
    quantity = F.col("l_quantity").cast("bigint")

    def document(p: str, space: str, bare: bool, put: bool) -> Column:
        # Spark interprets what stands in a lambda, piece by piece, so each entry is cut into the
        # part that depends on its number and the rest, which joins the entries of a document.
        group, end = ("", "") if bare else (f"<{p}shrsOrPrnAmt>", f"</{p}shrsOrPrnAmt>")
        choice = f"<{p}putCall>Put</{p}putCall>" if put else ""

        def entry(i: Column) -> Column:
            number = i.cast("string")
            value = F.when(i == 3, "").when(i % 2 == 0, F.concat(number, F.lit(","), "_rest")).otherwise(F.concat(number, "_rest"))
            return F.concat(
                value, F.lit(f"</{p}value>{group}<{p}sshPrnamt>"), (quantity + i).cast("string"),
                F.lit(f"</{p}sshPrnamt><{p}sshPrnamtType>SH</{p}sshPrnamtType>{end}{choice}<{p}votingAuthority><{p}Sole>"), number,
            )

        head = F.concat(
            F.lit(f"<{p}infoTable><{p}nameOfIssuer>"), "_name", F.lit(f"</{p}nameOfIssuer><{p}cusip>"), "_cusip", F.lit(f"</{p}cusip><{p}value>")
        )
        tail = F.lit(f"</{p}Sole><{p}None>0</{p}None></{p}votingAuthority></{p}infoTable>")
        entries = F.call_function("array_join", F.transform(F.sequence(F.lit(1), lines), entry), F.concat(tail, head))
        # An entry with a null in it is none, and all entries of a document share their nulls.
        body = F.when(part.isNull() | quantity.isNull(), F.when(lines.isNotNull(), "")).otherwise(F.concat(head, entries, tail))
        return F.concat(F.lit(f'<?xml version="1.0"?><{p}informationTable {space}>'), body, F.lit(f"</{p}informationTable>"))

    plain = 'xmlns="urn:holdings"'
    # Rendering and parsing XML is heavy per row, so the rows are dealt out first; a
    # real landing folder is already split over many files.
    columns = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    # With ``by_filer`` a task gets a filer's documents together.
    rows = t("lineitem").select(*columns)
    rows = spread(rows, ROWS_BY_FILER, ["l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]) if by_filer else spread(rows)
    digits = part.cast("string")
    rows = rows.select(
        *columns, F.concat(F.lit(" Issuer "), digits, F.lit(" &amp; Co ")).alias("_name"), padded(part, 9).alias("_cusip"),
        F.lpad((part % 1000).cast("string"), 3, "0").alias("_rest"),
    )
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(flag == "A", document("n1:", 'xmlns:n1="urn:holdings"', False, True))
        .when(flag == "N", document("", plain, True, True))
        .when(flag != "R", document("", plain, False, True))
        .otherwise(document("", plain, False, False))
        .alias("xml"),
    )


KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

HOLDINGS_SQL = """
holdings AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, i - 1 AS position,
    'Issuer ' || l_partkey || ' & Co' AS name_of_issuer, lpad(CAST(l_partkey AS VARCHAR), CAST(greatest(9, length(CAST(l_partkey AS VARCHAR))) AS INTEGER), '0') AS cusip,
    CASE WHEN i = 3 THEN '' WHEN i % 2 = 0 THEN i || ',' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0')
         ELSE i || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') END AS value,
    CASE WHEN i = 3 THEN -1 ELSE i * 1000 + l_partkey % 1000 END AS amount,
    CAST(CAST(l_quantity AS BIGINT) + i AS VARCHAR) AS ssh_prnamt,
    CASE WHEN l_returnflag = 'R' THEN '' ELSE 'Put' END AS put_call, CAST(i AS VARCHAR) AS sole
  FROM lineitem, LATERAL (SELECT unnest(range(1, l_linenumber + 1)) AS i)
)"""


@suite.register(f"""WITH {HOLDINGS_SQL}
SELECT l_orderkey, CAST(position AS BIGINT) AS position, name_of_issuer, '' AS title_of_class, cusip, value, ssh_prnamt,
  'SH' AS ssh_prnamt_type, put_call, '' AS investment_discretion, '' AS other_manager,
  sole AS voting_authority_sole, '' AS voting_authority_shared, '0' AS voting_authority_none
FROM holdings""")
def holdings_flatten(t: Tables) -> DataFrame:
    flat = H.flatten_holdings(holding_documents(t), ["l_orderkey"])
    return flat.withColumn("position", number("position"))


@suite.register(f"""WITH {HOLDINGS_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey
    ORDER BY amount DESC, position, l_orderkey, l_linenumber, l_partkey, ssh_prnamt, put_call) AS rn FROM holdings)
SELECT l_suppkey, CAST(rn AS BIGINT) AS value_rank, l_orderkey, CAST(position AS BIGINT) AS position, value, cusip
FROM ranked WHERE rn <= 25""")
def holdings_top25(t: Tables) -> DataFrame:
    """The 25 largest holdings per filer (supplier) over all its documents."""

    flat = H.flatten_holdings(holding_documents(t, by_filer=True), KEYS, columns=["cusip", "value", "ssh_prnamt", "put_call"])
    ties = ["position", "l_orderkey", "l_linenumber", "l_partkey", "ssh_prnamt", "put_call"]
    top = H.holdings_preview(flat, ["l_suppkey"], ties=ties)
    return top.select(
        "l_suppkey", number("value_rank").alias("value_rank"), "l_orderkey", number("position").alias("position"),
        "value", "cusip",
    )


@suite.register(f"""WITH {HOLDINGS_SQL}
SELECT l_orderkey, CAST(position AS BIGINT) AS position, CAST(amount AS BIGINT) AS amount FROM holdings""")
def holdings_sorted(t: Tables) -> DataFrame:
    flat = H.flatten_holdings(holding_documents(t), ["l_orderkey"], columns=["value"])
    amount = H.holding_value(F.col("value")).cast("bigint")
    valued = land(flat.select("l_orderkey", "position", amount.alias("amount")), "holdings")
    ordered = H.holdings_by_value(valued, ["l_orderkey"], "amount")
    return ordered.select("l_orderkey", number("position").alias("position"), "amount")


# --- submission feeds: parallel arrays of one to four reports per filer

FORMS = ("10-K", "13F-HR", "8-K", "13F-HR/A", "4")


def submissions(t: Tables) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    steps = F.sequence(F.lit(0).cast("bigint"), customer % 4)
    names = F.array(*[F.lit(f) for f in FORMS])

    def accession(i: Column) -> Column:
        return F.format_string("%010d-%02d-%06d", key, i, customer)

    dates = F.transform(steps, lambda i: F.date_format(F.date_add(F.col("o_orderdate").cast("date"), i.cast("int")), "yyyy-MM-dd"))
    return t("orders").select(
        key.cast("string").alias("cik"),
        F.transform(steps, lambda i: F.get(names, (key + i * i) % 5)).alias("form"),
        F.transform(steps, accession).alias("accession_number"),
        F.transform(steps, lambda i: F.concat(F.lit("primary_"), i.cast("string"), F.lit(".xml"))).alias("primary_document"),
        F.when(customer % 41 == 0, F.slice(dates, F.lit(2), F.size(dates))).otherwise(dates).alias("filing_date"),
    )


FILING_SQL = """
feed AS (
  SELECT o_orderkey AS k, o_custkey AS c, i, CAST(o_orderdate AS DATE) + CAST(i AS INTEGER) AS filed,
         (o_orderkey + i * i) % 5 AS f
  FROM orders, LATERAL (SELECT unnest(range(0, o_custkey % 4 + 1)) AS i)
), hits AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY i) AS rn FROM feed WHERE f IN (1, 3) AND c % 41 <> 0)
  WHERE rn = 1
), filings AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS cik, lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(10, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS padded_cik,
    CASE f WHEN 1 THEN '13F-HR' WHEN 3 THEN '13F-HR/A' END AS filing_type,
    printf('%010d-%02d-%06d', k, i, c) AS accession_number, 'primary_' || i || '.xml' AS primary_document,
    strftime(filed, '%Y-%m-%d') AS filing_date,
    CASE WHEN k IS NULL THEN 'https://www.sec.gov/Archives/edgar/data'
         ELSE 'https://www.sec.gov/Archives/edgar/data/' || k || '/' || replace(printf('%010d-%02d-%06d', k, i, c), '-', '')
    END AS filing_directory_url,
    CASE WHEN o_custkey % 41 = 0 THEN 'filing arrays differ in length'
         WHEN k IS NULL THEN 'No public 13F filing found for CIK ' || o_orderkey END AS error
  FROM orders LEFT JOIN hits ON o_orderkey = k
)"""


@suite.register(f"WITH {FILING_SQL} SELECT * FROM filings")
def latest_filing(t: Tables) -> DataFrame:
    return H.latest_filing(submissions(t))


# --- filing directories: a primary document, 0 to 3 XML candidates, one other file

def listings(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    candidates = F.slice(
        F.array(F.lit("cover.xml"), F.lit("table.XML"), F.lit("extra.xml")), F.lit(1), (key % 4).cast("int")
    )
    holdings_root = '<?xml version="1.0"?><!-- data --><ns:informationTable xmlns:ns="u"></ns:informationTable>'
    root = F.transform(
        candidates,
        lambda n: F.when((n == "table.XML") | ((n == "extra.xml") & (key % 3 == 0)), holdings_root).otherwise(
            "<edgarSubmission><informationTable/></edgarSubmission>"
        ),
    )
    return t("orders").select(
        key.cast("string").alias("cik"),
        F.lit("primary.xml").alias("primary_document"),
        F.concat(F.array(F.lit("primary.xml"), F.lit("index.html")), candidates).alias("names"),
        F.concat(F.array(F.lit("<informationTable/>"), F.lit("<html/>")), root).alias("documents"),
    )


DOCUMENT_SQL = """
documents_found AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS cik,
    CASE o_orderkey % 4 WHEN 1 THEN 'cover.xml' WHEN 2 THEN 'table.XML' WHEN 3 THEN 'table.XML' END AS document_name
  FROM orders
)"""


@suite.register(f"""WITH {DOCUMENT_SQL}
SELECT cik, document_name, CASE WHEN document_name IS NULL THEN 'no holdings document in the directory' END AS error
FROM documents_found""")
def holdings_document(t: Tables) -> DataFrame:
    return H.holdings_document(listings(t), ["cik"])


@suite.register(f"""WITH {FILING_SQL}, {DOCUMENT_SQL}, counts AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS cik, CAST(sum(l_linenumber) AS BIGINT) AS n FROM lineitem GROUP BY 1)
SELECT c_name AS display_name, f.cik, filing_type, accession_number, filing_date, filing_directory_url,
  primary_document AS primary_document_name, filing_directory_url || '/' || primary_document AS primary_document_url,
  CASE WHEN document_name IS NULL THEN filing_directory_url
       ELSE filing_directory_url || '/' || document_name END AS information_table_url,
  coalesce(n, 0) AS holding_count, c_name AS filing_manager_name
FROM filings f JOIN documents_found d ON f.cik = d.cik LEFT JOIN counts c ON c.cik = f.cik
JOIN orders ON CAST(o_orderkey AS VARCHAR) = f.cik JOIN customer ON o_custkey = c_custkey
WHERE f.error IS NULL""")
def filing_metadata(t: Tables) -> DataFrame:
    holdings = H.flatten_holdings(holding_documents(t), ["l_orderkey"], columns=[]).select(
        F.col("l_orderkey").cast("string").alias("cik")
    )
    names = (
        t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("o_orderkey").cast("string").alias("cik"), F.col("c_name").alias("display_name"))
    )
    return H.filing_metadata(
        H.latest_filing(submissions(t)), H.holdings_document(listings(t), ["cik"]), holdings, names
    )


# --- landed files: documents of a filer in one file each, feeds as JSON

# Rows of a task that lands files: a few seconds' work.
FILES_PER_TASK = 2_000


def landed(t: Tables, rows: DataFrame, name: str, text: str, order: str | None = None, tasks: int | None = None) -> str:
    """Write ``text`` of every row to a file called ``name`` in a new folder; rows of one name are lines of one file.

    The lines of a file stand in the ``order`` of that column, if one is given.

    The tasks write the files under their final names. Spark's own writer gives a folder to
    each, which the driver then has to list and rename, one by one.
    """

    folder = work_dir(t.spark, "landed")
    tasks = tasks or max(t.spark.sparkContext.defaultParallelism, -(-rows.count() // FILES_PER_TASK))
    file_name = F.coalesce(F.col(name), F.lit("__HIVE_DEFAULT_PARTITION__"))
    lines = F.collect_list(text)
    if order is not None:
        lines = F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda line: line[text])
    files = (
        rows.select(file_name.alias(name), F.coalesce(F.col(text), F.lit("")).alias(text), *([order] if order else []))
        .repartition(tasks, name).groupBy(name).agg(F.array_join(lines, "\n").alias(text))
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for title, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_output_stream(f"{root}/{title}") as file:
                    file.write(f"{body}\n".encode())
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    files.mapInArrow(write, "files bigint").agg(F.sum("files")).collect()
    return folder


@suite.register("""
SELECT 'supplier_' || s_suppkey || '.xml' AS file_name, CAST(i - 1 AS BIGINT) AS position,
       s_name AS name_of_issuer, CAST((s_nationkey % 5) * 1000 + i AS VARCHAR) AS value
FROM supplier, LATERAL (SELECT unnest(range(1, (s_nationkey % 5) + 2)) AS i)""")
def landed_documents_read(t: Tables) -> DataFrame:
    """Holdings documents written as XML files, read as whole documents and flattened."""

    entry = F.transform(
        F.sequence(F.lit(1).cast("bigint"), (F.col("s_nationkey") % 5) + 1),
        lambda i: F.concat(
            F.lit("<infoTable><nameOfIssuer>"), F.col("s_name"), F.lit("</nameOfIssuer><value>"),
            ((F.col("s_nationkey") % 5) * 1000 + i).cast("string"), F.lit("</value></infoTable>"),
        ),
    )
    documents = t("supplier").select(
        F.concat(F.lit("supplier_"), "s_suppkey", F.lit(".xml")).alias("name"),
        F.concat(F.lit('<?xml version="1.0"?><informationTable>'), F.array_join(entry, ""), F.lit("</informationTable>")).alias("xml"),
    )
    read = read_documents(t.spark, landed(t, documents, "name", "xml"))
    flat = H.flatten_holdings(read, ["file_name"])
    return flat.select("file_name", number("position").alias("position"), "name_of_issuer", "value")


@suite.register("""
SELECT 'supplier_' || s_suppkey || '.xml' AS file_name, CAST(i - 1 AS BIGINT) AS position,
       CASE WHEN s_suppkey % 7 = 3 AND i = 1 THEN NULL ELSE s_name END AS name_of_issuer,
       CASE WHEN s_suppkey % 7 = 3 AND i = 1 THEN NULL ELSE CAST((s_nationkey % 5) * 1000 + i AS VARCHAR) END AS value,
       s_suppkey % 7 = 3 AND i = 1 AS corrupt
FROM supplier, LATERAL (SELECT unnest(range(1, (s_nationkey % 5) + 2)) AS i)
UNION ALL
SELECT 'large.xml', row_number() OVER (ORDER BY p_partkey) - 1, 'Part ' || p_partkey, CAST(p_size AS VARCHAR), false FROM part
UNION ALL SELECT 'large.xml', count(*), NULL, NULL, true FROM part""")
def damaged_documents_read(t: Tables) -> DataFrame:
    """Documents cut while they are read: some with a holding of crossed tags, a large one of a holding per part that breaks off."""

    first = F.col("s_suppkey") % 7 == 3
    entry = F.transform(
        F.sequence(F.lit(1).cast("bigint"), (F.col("s_nationkey") % 5) + 1),
        lambda i: F.concat(
            F.lit('<n1:infoTable a="1">\n <nameOfIssuer>'), F.col("s_name"),
            F.when(first & (i == 1), "</value>").otherwise("</nameOfIssuer>"), F.lit("<n1:value>"),
            ((F.col("s_nationkey") % 5) * 1000 + i).cast("string"), F.lit("</n1:value></n1:infoTable>"),
        ),
    )
    documents = t("supplier").select(
        F.concat(F.lit("supplier_"), "s_suppkey", F.lit(".xml")).alias("name"),
        F.concat(F.lit('<?xml version="1.0"?>\n<t xmlns:n1="urn:h">'), F.array_join(entry, "\n"), F.lit("</t>")).alias("xml"),
    )
    folder = landed(t, documents, "name", "xml")
    part = F.col("p_partkey").cast("string")
    line = F.concat(
        F.lit("<infoTable><nameOfIssuer>Part "), part, F.lit("</nameOfIssuer><value>"), F.col("p_size").cast("string"), F.lit("</value></infoTable>")
    )
    head = t.spark.range(1).select(F.lit(-1).cast("bigint").alias("k"), F.lit("<informationTable>").alias("line"))
    cut = t.spark.range(1).select(F.lit((1 << 62)).alias("k"), F.lit("<infoTable><nameOfIssuer>Half").alias("line"))
    lines = t("part").select(F.col("p_partkey").cast("bigint").alias("k"), line.alias("line")).unionByName(head).unionByName(cut)
    staged = work_dir(t.spark, "landing")
    lines.repartition(1).sortWithinPartitions("k").select("line").write.text(staged)  # one file, streamed to disk
    large = next(n for n in entry_names(t.spark, staged) if n.startswith("part-"))
    rename_path(t.spark, f"{staged}/{large}", f"{folder}/large.xml")
    found = H.parse_holdings(read_holding_records(t.spark, folder), ["file_name"])
    return found.select("file_name", "position", "name_of_issuer", "value", F.col("corrupt_record").isNotNull().alias("corrupt"))


@suite.register("""
SELECT CAST(s_suppkey AS VARCHAR) AS cik, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS padded_cik,
  CASE WHEN s_nationkey % 5 > 0 THEN '13F-HR' END AS filing_type, CASE WHEN s_nationkey % 5 > 0 THEN s_suppkey || '-24-2' END AS accession_number,
  CASE WHEN s_nationkey % 5 = 0 THEN 'No public 13F filing found for CIK ' || s_suppkey END AS error
FROM supplier""")
def landed_feeds_read(t: Tables) -> DataFrame:
    """Submission feeds written as JSON files, read with a declared schema; the first report of each filer."""

    key = F.col("s_suppkey").cast("string")
    forms = F.when((F.col("s_nationkey") % 5) > 0, F.array(F.lit("10-K"), F.lit("13F-HR"))).otherwise(F.array(F.lit("10-K"), F.lit("8-K")))
    recent = F.struct(
        forms.alias("form"), F.array(F.concat(key, F.lit("-24-1")), F.concat(key, F.lit("-24-2"))).alias("accessionNumber"),
        F.array(F.lit("a.xml"), F.lit("b.xml")).alias("primaryDocument"),
        F.array(F.lit("2024-01-01"), F.lit("2024-02-01")).alias("filingDate"),
    )
    feeds = t("supplier").select(
        F.concat(F.lit("CIK"), key, F.lit(".json")).alias("name"),
        F.to_json(F.struct(key.alias("cik"), F.struct(recent.alias("recent")).alias("filings"))).alias("feed"),
    )
    found = H.latest_filing(read_submissions(t.spark, landed(t, feeds, "name", "feed")))
    return found.select("cik", "padded_cik", "filing_type", "accession_number", "error")


@suite.register(f"""WITH {HOLDINGS_SQL}
SELECT l_orderkey, CAST(position AS BIGINT) AS position, cusip, value FROM holdings""")
def holdings_csv_round_trip(t: Tables) -> DataFrame:
    """Flattened holdings written as CSV and read back; empty fields stay empty text."""

    path = work_dir(t.spark, "holdings-csv")
    flat = H.flatten_holdings(holding_documents(t), ["l_orderkey"], columns=["cusip", "value"])
    write_holdings_csv(flat, path)
    back = read_csv(t.spark, path, "l_orderkey bigint, position bigint, cusip string, value string")
    return back.withColumn("value", F.coalesce("value", F.lit("")))
