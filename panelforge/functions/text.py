"""Text clean-up, identifiers and report wording."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelforge.functions.numbers import strip


def blank_to_empty(text: Column) -> Column:
    """Strip; NULL becomes the empty string."""

    return strip(F.coalesce(text, F.lit("")))


def blank_to_null(text: Column) -> Column:
    """Strip; blank becomes NULL."""

    return F.nullif(blank_to_empty(text), F.lit(""))


def padded_cik(cik: Column) -> Column:
    """Filer id padded with zeros to ten digits; a longer id stays whole."""

    digits = cik.cast("bigint").cast("string")
    return F.lpad(digits, F.greatest(F.lit(10), F.length(digits)), F.lit("0"))


def legacy_root(symbol: Column) -> Column:
    """First part of a legacy ``root.suffix`` option symbol."""

    return F.split_part(symbol, F.lit("."), F.lit(1))


def legacy_suffix(symbol: Column) -> Column:
    return F.split_part(symbol, F.lit("."), F.lit(2))


def family_name(table_name: Column) -> Column:
    """Replace a trailing four-digit year by ``YYYY``."""

    return F.regexp_replace(table_name, "[0-9]{4}$", "YYYY")


# Wording of a derivation check, by how many rows matched.
NONE_CHECKED = "No rows were checked."
ALL_MATCHED = "All %d checked rows were recoverable from smaller source tables."
NONE_MATCHED = "None of the %d checked rows were recoverable from smaller source tables."
SOME_MATCHED = "Only %d of %d checked rows were recoverable from smaller source tables."
UNORDERED_NOTE = " The sample uses an unordered LIMIT query, so reruns may inspect different rows."


def interpretation(matched: Column, checked: Column, ordered_sample: bool) -> Column:
    """Wording for a checked/matched pair of counts."""

    summary = (
        F.when(checked <= 0, F.lit(NONE_CHECKED))
        .when(matched == checked, F.format_string(ALL_MATCHED, checked))
        .when(matched == 0, F.format_string(NONE_MATCHED, checked))
        .otherwise(F.format_string(SOME_MATCHED, matched, checked))
    )
    return summary if ordered_sample else F.concat(summary, F.lit(UNORDERED_NOTE))
