"""Row digests for snapshot comparison and deterministic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_text(columns: Sequence[str]) -> Column:
    """Unambiguous text form of a row: length-prefixed values, ``~`` for NULL."""

    def field(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.when(text.isNull(), F.lit("~")).otherwise(
            F.concat(F.length(text).cast("string"), F.lit(":"), text)
        )

    return F.concat_ws("|", *[field(name) for name in columns])


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of the row text, 32 bytes."""

    return F.unhex(F.sha2(row_text(columns), 256))


def rows_fingerprint(columns: Sequence[str]) -> Column:
    """Aggregate: a fingerprint of the rows as a multiset, whatever their order or partitioning.

    The MD5 of each row is cut into four 32-bit numbers, and each is summed over all rows.
    Partial sums merge, so it costs no shuffle of rows and fits into the pass that writes.
    Copies count as often as they occur. It tells changes, not attacks.
    """

    text = F.md5(row_text(columns))
    sums = [
        F.sum(F.conv(F.substring(text, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")) for i in range(4)
    ]
    return F.concat_ws(":", *[F.coalesce(s.cast("string"), F.lit("0")) for s in sums])
