"""Minute-bar text lines: strict parsing, rejects and an issue report.

Input rows carry ``file_name``, ``line_number`` and ``line``. Good rows, rejects
and issues come out of one narrow pass each. Values that several later
expressions share (the split fields, the parsed numbers) are produced by a
one-element explode: a filter on them then cannot be pushed below it, where it
would split and parse every line again for each field it looks at.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.dates import local_to_utc, parse_bar_timestamp
from panelforge.functions.numbers import is_finite, parse_number, strip

# File names and field names.
FULL_FILE = r"^(.+)_full_1min(?:_.+)?$"
PLAIN_FILE = r"^(.+)_1min$"
FIELDS = ("timestamp", "open", "high", "low", "close", "volume")
PRICES = ("open", "high", "low", "close", "volume")
COMMA_OUTSIDE_QUOTES = r",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)"


def file_stem(file_name: Column) -> Column:
    return F.regexp_replace(file_name, r"\.[^.]*$", "")


def symbol_of(file_name: Column) -> Column:
    """Upper-case symbol from a bar file name; NULL for other files."""

    stem = file_stem(file_name)
    found = F.when(stem.rlike(FULL_FILE), F.regexp_extract(stem, FULL_FILE, 1)).when(
        stem.rlike(PLAIN_FILE), F.regexp_extract(stem, PLAIN_FILE, 1)
    )
    return F.nullif(F.upper(strip(found)), F.lit(""))


def split_fields(line: Column) -> Column:
    """Comma-separated fields; quoted fields may hold commas and doubled quotes."""

    quoted = F.transform(
        F.split(line, COMMA_OUTSIDE_QUOTES, -1),
        lambda f: F.when(
            f.rlike('^".*"$'), F.replace(F.regexp_replace(f, '^"|"$', ""), F.lit('""'), F.lit('"'))
        ).otherwise(f),
    )
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ",", -1))


def once(value: Column) -> Column:
    """Generator that yields its argument as one row."""

    return F.explode(F.array(value))


def with_fields(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Lines that are not empty, with their fields."""

    return lines.where(F.length("line") > 0).select(
        "file_name", "line_number", "line", *keep, once(split_fields(F.col("line"))).alias("fields")
    )


def parse_bars(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed bar values plus ``error`` (NULL for accepted lines) and ``negatives``.

    Exactly six fields, a timestamp, four numbers and a finite volume are
    required. Negative values are accepted and listed as warnings. ``local_ts``
    is the wall-clock time as written. ``keep`` names further columns to pass on.
    """

    place = F.concat(F.col("file_name"), F.lit(":"), F.col("line_number").cast("string"))
    # get() returns NULL past the end, so short lines reach the error text.
    raw = {name: F.get("fields", F.lit(i)) for i, name in enumerate(FIELDS)}
    values = F.struct(
        parse_bar_timestamp(raw["timestamp"]).alias("local_ts"),
        *[parse_number(raw[name]).alias(name) for name in PRICES],
    )
    parsed = (
        with_fields(lines, keep)
        .select("file_name", "line_number", "line", *keep, "fields", once(values).alias("v"))
        .select("file_name", "line_number", "line", *keep, "fields", "v.*")
    )

    # The wording of the errors is fixed output.
    error = F.when(
        F.size("fields") != len(FIELDS),
        F.concat(place, F.lit(" expected 6 columns, got "), F.size("fields").cast("string")),
    ).when(
        F.col("local_ts").isNull(),
        F.concat(place, F.lit(" timestamp does not match YYYY-mm-dd HH:MM:SS: "), raw["timestamp"]),
    )
    for name in PRICES:
        error = error.when(
            F.col(name).isNull(),
            F.concat(place, F.lit(f" {name} must be a numeric value, got "), raw[name]),
        )
    error = error.when(
        ~is_finite(F.col("volume")),
        F.concat(place, F.lit(" volume must be a finite numeric value, got "), raw["volume"]),
    )
    negatives = F.array_compact(F.array(*[F.when(F.col(name) < 0, F.lit(name)) for name in PRICES]))
    return parsed.select(
        "file_name", "line_number", "line", symbol_of(F.col("file_name")).alias("symbol"), "local_ts", *PRICES,
        error.alias("error"), negatives.alias("negatives"), *keep,
    )


def with_utc(parsed: DataFrame, zone: str, utc_symbols: Iterable[str] = ()) -> DataFrame:
    """Add ``ts`` in UTC; listed symbols are already in UTC."""

    already = sorted({s.strip().upper() for s in utc_symbols if s.strip()})
    converted = local_to_utc(F.col("local_ts"), zone)
    ts = F.when(F.col("symbol").isin(already), F.col("local_ts")).otherwise(converted) if already else converted
    return parsed.withColumn("ts", ts)


def good_bars(parsed: DataFrame, zone: str, utc_symbols: Iterable[str] = ()) -> DataFrame:
    """Accepted rows in the stored shape."""

    return with_utc(parsed.where(F.col("error").isNull()), zone, utc_symbols).select("symbol", "ts", *PRICES)


def rejects(parsed: DataFrame) -> DataFrame:
    """Rejected lines with file, line number, reason and the raw line."""

    return parsed.where(F.col("error").isNotNull()).select("file_name", "line_number", "error", "line")


def negative_warnings(parsed: DataFrame) -> DataFrame:
    return (
        parsed.where(F.col("error").isNull() & (F.size("negatives") > 0))
        .select("file_name", "line_number", F.explode("negatives").alias("column_name"))
    )


def line_issues(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every issue of every line, as (file_name, line_number, column_name, issue, value).

    A wrong field count ends the checks of that line. Fields are stripped first.
    A numeric field reports one issue only: non-numeric, non-finite or negative.
    """

    stripped = F.transform(F.col("fields"), strip)
    numbers = F.transform(F.col("f"), parse_number)
    rows = (
        with_fields(lines, keep)
        .select("file_name", "line_number", "line", *keep, once(stripped).alias("f"))
        .select("file_name", "line_number", "line", *keep, "f", once(numbers).alias("n"))
    )
    values = [F.get("f", F.lit(i)) for i in range(len(FIELDS))]

    def issue(test: Column, column: str, kind: str, value: Column) -> Column:
        return F.when(
            test, F.struct(F.lit(column).alias("column_name"), F.lit(kind).alias("issue"), value.alias("value"))
        )

    empty = [issue(v == "", name, "empty", F.lit("")) for name, v in zip(FIELDS, values)]
    stamp = [
        issue((values[0] != "") & parse_bar_timestamp(values[0]).isNull(), "timestamp",
              "unparseable timestamp", values[0])
    ]
    numeric = []
    for i, name in enumerate(FIELDS[1:], start=1):
        value, number = values[i], F.get("n", F.lit(i))
        kind = (
            F.when(value == "", F.lit(None).cast("string"))
            .when(number.isNull(), "non-numeric")
            .when(~is_finite(number), "non-finite")
            .when(number < 0, "negative")
        )
        numeric.append(
            F.when(
                kind.isNotNull(),
                F.struct(F.lit(name).alias("column_name"), kind.alias("issue"), value.alias("value")),
            )
        )
    wrong_count = F.array(
        F.struct(
            F.lit("").alias("column_name"),
            F.concat(F.lit("wrong column count: expected 6, got "), F.size("f").cast("string")).alias("issue"),
            F.col("line").alias("value"),
        )
    )
    found = F.when(F.size("f") != len(FIELDS), wrong_count).otherwise(F.array(*empty, *stamp, *numeric))
    # The outer form keeps the optimizer from testing the whole list once more
    # before it explodes it.
    return (
        rows.select("file_name", "line_number", *keep, F.explode_outer(found).alias("i"))
        .where(F.col("i").isNotNull())
        .select("file_name", "line_number", *keep, "i.*")
    )


def file_report(files: DataFrame, issues: DataFrame) -> DataFrame:
    """Issue count and OK / not OK per file; files without issues appear too."""

    counts = issues.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))
    return files.select("file_name").distinct().join(counts, "file_name", "left").select(
        "file_name",
        F.coalesce("n", F.lit(0)).alias("issue_count"),
        F.when(F.col("n").isNull(), "OK").otherwise("issues found").alias("status"),
    )


def last_field_max(lines: DataFrame) -> DataFrame:
    """Largest number in the last comma-separated field, per file.

    Text that is not a number is ignored and NaN never wins. A file without
    any number above minus infinity gives NULL.
    """

    number = parse_number(F.substring_index(strip(F.col("line")), ",", -1))
    usable = F.when(~F.isnan(number) & (number != F.lit(float("-inf"))), number)
    return lines.groupBy("file_name").agg(F.max(usable).alias("max_last_field"))
