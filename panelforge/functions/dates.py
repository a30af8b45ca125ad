"""Date and local-time parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date and bar-timestamp spellings.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
COMPACT_DATE = r"^\d{8}$"
ISO_DATE_TIME = (
    r"^\d{4}-\d{2}-\d{2}[T ]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?$"
)
BAR_TIMESTAMP = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}$"


def strict_date(value: Column, type_name: str) -> Column:
    """Date from a date, a timestamp or ISO text; NULL where text is not a date.

    A bare cast would turn ``2005`` into 2005-01-01, so text must show all
    three parts. Far-future sentinels such as 9000-01-01 are kept.
    """

    if type_name != "string":
        return value.cast("date")
    return F.when(value.rlike(ISO_DATE), value.try_cast("date")).when(
        value.rlike(COMPACT_DATE),
        F.regexp_replace(value, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3").try_cast("date"),
    )


def lenient_date(value: Column, type_name: str) -> Column:
    """As :func:`strict_date`, and the date part of an ISO date-time; anything after it makes the text no date."""

    if type_name != "string":
        return value.try_cast("date")
    return F.coalesce(
        strict_date(value, type_name), F.when(value.rlike(ISO_DATE_TIME), F.left(value, F.lit(10)).try_cast("date"))
    )


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def parse_bar_timestamp(text: Column) -> Column:
    """Zone-less timestamp from ``YYYY-mm-dd HH:MM:SS`` (unpadded parts allowed)."""

    return F.when(
        text.rlike(BAR_TIMESTAMP), F.regexp_replace(text, r"\s+", " ").try_cast("timestamp_ntz")
    )


def local_to_utc(local: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` to zone-less UTC.

    Times inside a spring gap move forward, times in an autumn overlap take
    the earlier instant.
    """

    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
