"""Holdings filings: document choice, XML flattening, ordering, metadata."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from panelforge.functions.numbers import strip
from panelforge.functions.plain_xml import Layout, read_plain, steps
from panelforge.functions.text import padded_cik
from panelforge.session import map_arrow

# Report forms, preview size, document element names.
FILING_FORMS = ("13F-HR", "13F-HR/A")
PREVIEW_ROWS = 25
ARCHIVE_ROOT = "https://www.sec.gov/Archives/edgar/data"
SHARES = "shrsOrPrnAmt"
VOTING = "votingAuthority"
# Output column, parent element (None = the holding itself), element name.
HOLDING_FIELDS = (
    ("name_of_issuer", None, "nameOfIssuer"),
    ("title_of_class", None, "titleOfClass"),
    ("cusip", None, "cusip"),
    ("value", None, "value"),
    ("ssh_prnamt", SHARES, "sshPrnamt"),
    ("ssh_prnamt_type", SHARES, "sshPrnamtType"),
    ("put_call", None, "putCall"),
    ("investment_discretion", None, "investmentDiscretion"),
    ("other_manager", None, "otherManager"),
    ("voting_authority_sole", VOTING, "Sole"),
    ("voting_authority_shared", VOTING, "Shared"),
    ("voting_authority_none", VOTING, "None"),
)


def holding_schema(fields: Sequence[tuple[str, str | None, str]] = HOLDING_FIELDS) -> str:
    """Schema of a holdings document; leaves are lists so the first of several wins."""

    def leaves(names) -> str:
        return ", ".join(f"`{name}`: array<string>" for name in names)

    nested = [
        f"`{parent}`: array<struct<{leaves(e for _, p, e in fields if p == parent)}>>"
        for parent in (SHARES, VOTING)
        if any(p == parent for _, p, _ in fields)
    ]
    every = leaves(element for _, _, element in fields)
    return f"infoTable array<struct<{', '.join([every, *nested])}>>"


def _first(values: Column) -> Column:
    return strip(F.coalesce(F.get(values, F.lit(0)), F.lit("")))


def flatten_holdings(
    documents: DataFrame, keys: list[str], xml: str = "xml", columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per holding with its position in the document.

    Namespaces are ignored and a missing element is an empty string. Amount and
    voting fields are read from their group, or from the holding itself when
    the group is absent. A malformed document fails the job. ``columns`` names the
    output fields that are wanted, all by default.

    Documents of plain build are read many at once (:mod:`panelforge.functions.plain_xml`);
    all others come through that step as they are and go to ``from_xml``. Spark does not prune
    the schema of a parsed document, so only wanted fields are in it.
    """

    fields = [f for f in HOLDING_FIELDS if columns is None or f[0] in columns]
    names = [name for name, _, _ in fields]
    layout = Layout("infoTable", [(parent, element) for _, parent, element in fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = batch.column(len(keys)), [*keys, "position", *names, "_xml"]
            for low, high in steps(texts):
                part = batch.slice(low, high - low)
                others, document, position, columns = read_plain(part.column(len(keys)), layout)
                for rows, place, found, rest in (
                    (document, position, columns, False), (others, None, [None] * len(names), True)
                ):
                    if not len(rows):
                        continue
                    of = part.take(pa.array(rows))
                    null, place = pa.nulls(len(rows), texts.type), pa.nulls(len(rows), pa.int32()) if place is None else pa.array(place)
                    found = [null if c is None else c.cast(texts.type) for c in found]
                    yield pa.RecordBatch.from_arrays([*of.columns[:-1], place, *found, of.columns[-1] if rest else null], labels)

    given = documents.select(*keys, F.col(xml).alias("_xml"))
    schema = StructType([
        *[StructField(f.name, f.dataType) for f in given.schema[:-1]], StructField("position", IntegerType()),
        *[StructField(name, StringType()) for name in [*names, "_xml"]],
    ])
    parsed = F.from_xml(F.col("_xml"), holding_schema(fields or HOLDING_FIELDS[:1]), {"ignoreNamespace": "true", "mode": "FAILFAST"})
    # The outer form keeps the plain documents' rows, and the optimizer from adding a size
    # test below the explode, which would parse a document a second time.
    exploded = map_arrow(given, read, schema).select(
        *keys, "position", *names, F.posexplode_outer(F.when(F.col("_xml").isNotNull(), parsed["infoTable"])).alias("_position", "_h")
    )
    place = F.coalesce("position", "_position")
    return exploded.where(place.isNotNull()).select(
        *keys, place.alias("position"), *[F.coalesce(F.col(n), c).alias(n) for n, c in zip(names, _fields(F.col("_h"), fields))]
    )


def _fields(holding: Column, fields: Sequence[tuple[str, str | None, str]] = HOLDING_FIELDS) -> list[Column]:
    """The output columns of one parsed holding."""

    def leaf(parent: str | None, element: str) -> Column:
        own = holding.getField(element)
        if parent is None:
            return _first(own)
        group = F.get(holding.getField(parent), F.lit(0))
        present = F.size(F.coalesce(holding.getField(parent), F.array())) > 0
        return F.when(present, _first(group.getField(element))).otherwise(_first(own))

    return [leaf(parent, element).alias(name) for name, parent, element in fields]


def parse_holdings(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Holdings from the records of :func:`panelforge.sources.documents.read_holding_records`.

    A record that is no well-formed holding keeps its place: its fields are NULL and its text
    stands in ``corrupt_record``, which is NULL for all others. Nothing fails the job.
    """

    schema = holding_schema().removeprefix("infoTable array<").removesuffix(">>") + ", `_corrupt`: string>"
    options = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = records.withColumn("h", F.from_xml(F.col("record"), schema, options))
    bad = ~F.col("closed") | F.col("h").isNull() | F.col("h._corrupt").isNotNull()
    fields = [F.when(~bad, c).alias(name) for c, (name, _, _) in zip(_fields(F.col("h")), HOLDING_FIELDS)]
    return parsed.select(*keys, "position", *fields, F.when(bad, F.col("record")).alias("corrupt_record"))


def holding_value(value: Column) -> Column:
    """Reported value as a number: commas dropped, blank is -1, other text fails."""

    text = F.replace(value, F.lit(","), F.lit(""))
    return (
        F.when(text == "", F.lit(-1).cast("decimal(38,0)"))
        .when(text.rlike(r"^[0-9]{1,18}\z"), text.cast("bigint").cast("decimal(38,0)"))  # as below, only cheaper
        .when(text.rlike(r"^\s*[+-]?\d+(_\d+)*\s*$"), F.replace(strip(text), F.lit("_"), F.lit("")).cast("decimal(38,0)"))
        .otherwise(F.raise_error(F.concat(F.lit("holding value is not a number: "), value)).cast("decimal(38,0)"))
    )


def holdings_by_value(holdings: DataFrame, keys: list[str], amount: str | None = None) -> DataFrame:
    """Largest value first within each filing; ties keep document order.

    ``amount`` names a column that has the value as a number already. The number is a column
    of its own either way, since a sort works out an expression anew at every comparison.
    """

    if amount is not None:
        return holdings.orderBy(*keys, F.col(amount).desc(), "position")
    valued = holdings.withColumn("_value", holding_value(F.col("value")))
    return valued.orderBy(*keys, F.col("_value").desc(), "position").drop("_value")


def holdings_preview(
    holdings: DataFrame, keys: list[str], rows: int = PREVIEW_ROWS, ties: Sequence[str] = ("position",)
) -> DataFrame:
    """Top holdings per filing with their rank; cut per input partition before the shuffle.

    The sorts compare a 64-bit number first, which holds the value up to its own bounds; only
    where it is equal do they compare the decimal, which has to be made anew each time.
    """

    value, bound = F.col("_value"), 1 << 62
    near = F.when(value > bound, bound).when(value < -bound, -bound).otherwise(value.cast("bigint"))
    ranked = Window.partitionBy(*keys).orderBy(F.col("_near").desc(), value.desc(), *ties)
    return (
        holdings.withColumn("_value", holding_value(F.col("value")))
        .withColumn("_near", near)
        .withColumn("value_rank", F.row_number().over(ranked))
        .where(F.col("value_rank") <= rows)
        .drop("_value", "_near")
    )


def latest_filing(submissions: DataFrame) -> DataFrame:
    """First report of a wanted form in feed order, from parallel arrays.

    The arrays ``form``, ``accession_number``, ``primary_document`` and
    ``filing_date`` of a filer stay in their row: no explode and no shuffle.
    ``error`` tells of unequal lengths or of no such report.
    """

    size = F.size("form")
    equal = (
        (size == F.size("accession_number")) & (size == F.size("primary_document"))
        & (size == F.size("filing_date"))
    )
    zipped = F.arrays_zip("form", "accession_number", "primary_document", "filing_date")
    hit = F.get(F.filter(zipped, lambda f: f["form"].isin(*FILING_FORMS)), F.lit(0))
    chosen = submissions.withColumn("_hit", F.when(equal, hit)).withColumn("_equal", equal)
    accession = F.col("_hit.accession_number")
    return chosen.select(
        "cik",
        padded_cik(F.col("cik")).alias("padded_cik"),
        F.col("_hit.form").alias("filing_type"),
        accession.alias("accession_number"),
        F.col("_hit.primary_document").alias("primary_document"),
        F.col("_hit.filing_date").alias("filing_date"),
        F.concat_ws(
            "/",
            F.lit(ARCHIVE_ROOT),
            F.when(accession.isNotNull(), F.col("cik").cast("bigint").cast("string")),
            F.replace(accession, F.lit("-"), F.lit("")),
        ).alias("filing_directory_url"),
        F.when(~F.coalesce(F.col("_equal"), F.lit(False)), "filing arrays differ in length")
        .when(F.col("_hit").isNull(), F.concat(F.lit("No public 13F filing found for CIK "), F.col("cik").cast("string")))
        .alias("error"),
    )


def holdings_document(listings: DataFrame, keys: list[str]) -> DataFrame:
    """Name of the holdings document of each filing directory.

    ``names`` and ``documents`` are parallel arrays of a directory listing.
    Candidates end in ``.xml`` (any case) and are not the primary document. A
    single candidate is taken as it is; among several, the first whose root is
    ``informationTable``.
    """

    files = F.arrays_zip("names", "documents")
    candidates = F.filter(
        files, lambda f: F.lower(f["names"]).endswith(".xml") & (f["names"] != F.col("primary_document"))
    )
    with_root = F.filter(
        F.col("_c"), lambda f: F.coalesce(f["documents"], F.lit("")).rlike(ROOT_IS_HOLDINGS)
    )
    return (
        listings.withColumn("_c", candidates)
        .withColumn(
            "document_name",
            F.when(F.size("_c") == 1, F.get("_c", F.lit(0))["names"]).otherwise(
                F.get(with_root, F.lit(0))["names"]
            ),
        )
        .select(
            *keys,
            "document_name",
            F.when(F.col("document_name").isNull(), "no holdings document in the directory").alias("error"),
        )
    )


# First element after declaration, comments and processing instructions.
ROOT_IS_HOLDINGS = r"(?s)^\s*(<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*<([A-Za-z_][\w.-]*:)?informationTable[\s/>]"


def filing_metadata(filings: DataFrame, documents: DataFrame, holdings: DataFrame, names: DataFrame) -> DataFrame:
    """One row of metadata per filer with the number of holdings.

    ``holdings`` carries ``cik``; counting happens before the join.
    """

    counts = holdings.groupBy("cik").agg(F.count(F.lit(1)).alias("holding_count"))
    url = F.col("filing_directory_url")
    return (
        filings.where(F.col("error").isNull())
        .join(documents.select("cik", "document_name"), "cik")
        .join(counts, "cik", "left")
        .join(names.select("cik", "display_name"), "cik", "left")
        .select(
            "display_name",
            "cik",
            "filing_type",
            "accession_number",
            "filing_date",
            "filing_directory_url",
            F.col("primary_document").alias("primary_document_name"),
            F.concat_ws("/", url, "primary_document").alias("primary_document_url"),
            F.concat_ws("/", url, "document_name").alias("information_table_url"),
            F.coalesce("holding_count", F.lit(0)).alias("holding_count"),
            F.col("display_name").alias("filing_manager_name"),
        )
    )
