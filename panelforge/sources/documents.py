"""Landed filing documents: whole XML files and submission feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SUBMISSION_SCHEMA = (
    "cik string, filings struct<recent struct<form array<string>, accessionNumber array<string>, "
    "primaryDocument array<string>, filingDate array<string>>>"
)


def read_documents(spark: SparkSession, folder: str, pattern: str = "*.xml") -> DataFrame:
    """One row per document: file_name, xml."""

    return (
        spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
        .select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("xml"))
    )


def read_submissions(spark: SparkSession, folder: str) -> DataFrame:
    """Submission feeds (one JSON document per file) as parallel arrays per filer."""

    feed = spark.read.schema(SUBMISSION_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(folder)
    recent = F.col("filings.recent")
    return feed.select(
        "cik",
        recent["form"].alias("form"),
        recent["accessionNumber"].alias("accession_number"),
        recent["primaryDocument"].alias("primary_document"),
        recent["filingDate"].alias("filing_date"),
    )


# Fixed value: the element of one holding. A piece before the end of its opening or closing
# tag ends like this; a tag may carry a namespace prefix.
HOLDING = "infoTable"
OPENS, CLOSES = r"<(?:[\w.-]+:)?$", r"</(?:[\w.-]+:)?$"


def read_holding_records(spark: SparkSession, folder: str, pattern: str = "*.xml") -> DataFrame:
    """Documents cut into their holdings while they are read: ``file_name``, ``position``, ``record``, ``closed``.

    The end of the holding's tags is the reader's line separator. A document of any size is
    thereby split over tasks like a text file, and no task holds more than one holding. What
    stands between two tags ends with an opening bracket, which tells a holding from the text
    around it. ``position`` counts from 0 in the document: holdings are numbered in each file
    split, and one row per split adds those before it. A last holding without an end, as a cut
    document leaves it, is a record that is not ``closed``.
    """

    text = spark.read.option("pathGlobFilter", pattern).option("lineSep", f"{HOLDING}>").text(folder)
    placed = text.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("place"),
    )
    value = F.col("value")
    closed = value.rlike(CLOSES)
    # The last piece of a document has no separator after it; it is a cut holding if it follows an
    # opening tag. At the head of a split, where that tag is not seen, its own text tells: behind
    # a whole holding only closing tags are left.
    after = F.lag("value").over(Window.partitionBy("file", "split").orderBy("place"))
    alone = (F.col("split") > 0) & ~value.rlike(OPENS) & ~value.rlike(r"^\s*(</|$)")
    opened = F.coalesce(after.rlike(OPENS), alone)
    tag = rf"(?s)^.*<(?:[\w.-]+:)?{HOLDING}\s[^>]*>"  # an opening tag with attributes stays in the piece
    body = F.regexp_replace(F.regexp_replace(value, CLOSES, ""), tag, "")
    marked = placed.withColumns({"closed": closed, "opened": opened, "body": body})
    records = marked.where("closed or (opened and not closed)")
    numbered = records.withColumn("nth", F.row_number().over(Window.partitionBy("file", "split").orderBy("place")))
    counts = records.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("file").alias("_file"), F.col("split").alias("_split"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")
    )
    joined = numbered.join(offsets, (F.col("file") == F.col("_file")) & (F.col("split") == F.col("_split")))
    whole = F.concat(F.lit(f"<{HOLDING}>"), "body", F.lit(f"</{HOLDING}>"))
    return joined.select(
        "file_name", (F.col("offset") + F.col("nth") - 1).cast("bigint").alias("position"),
        F.when(F.col("closed"), whole).otherwise(F.col("value")).alias("record"), "closed",
    )
