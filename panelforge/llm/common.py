"""Helpers shared by the corpus operators: Arrow text views and label folds."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.session import land, map_arrow

# Bytes of text that one vectorised step works on; larger single texts are taken whole.
SLICE_BYTES = 1 << 20


def text_views(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and its row bounds; null counts as empty."""

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data if data is not None else b"", dtype=np.uint8), bounds


def slices(bounds: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; every row is in exactly one, an oversized row alone."""

    rows, low = len(bounds) - 1, 0
    while low < rows:
        high = int(np.searchsorted(bounds, bounds[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


def learnable(id_column: str | Column) -> Column:
    """True for rows that a model may learn from: crc32 of the id as text, mod 3, is not 1."""

    c = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.coalesce(F.crc32(c.cast("string")) % 3 != 1, F.lit(False))


def held_out(id_column: str | Column) -> Column:
    """True where the remainder is 1; a null id is never held out."""

    c = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.coalesce(F.crc32(c.cast("string")) % 3 == 1, F.lit(False))


def thinned(key: Column, rows: int, wanted: int) -> Column:
    """True for about four times ``wanted`` of ``rows`` rows, those with a small hash of ``key``; for all if there are fewer.

    Put before a top-k by hash, it keeps what the tasks send to the driver near the
    size of the answer, however many tasks there are.
    """

    steps = 1 << 40
    return F.pmod(F.xxhash64(key, F.lit(17)), F.lit(steps)) < int(steps * min(1.0, 4 * wanted / max(rows, 1)))


def require(df: DataFrame, *names: str) -> None:
    """Fail early, with the names, when a column is missing."""

    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""

    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(df: DataFrame, row: str) -> DataFrame:
    """``df`` stored with a number for each row in a column ``row``.

    The cut of files into partitions, and with it a number made in a scan, may differ
    from one scan to the next. Steps that match rows of two scans read this column.
    """

    return land(df.withColumn(row, F.monotonically_increasing_id()), "numbered-rows")


def release_memory() -> None:
    """Give freed memory back to the system; a Python worker outlives its task and would keep it."""

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library, which trims by itself or not at all
        pass


def filter_rows(df: DataFrame, extra: dict[str, Column], decide) -> DataFrame:
    """Rows of ``df`` for which ``decide`` says so, decided in place without a shuffle.

    ``decide`` gets the ``extra`` columns of an Arrow batch, in order, and returns a mask.
    The extra columns get names that ``df`` does not use.
    """

    names = [free_name(df, f"_{key}") for key in extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = np.asarray(decide(*[batch.column(n) for n in names]), dtype=bool)
            yield batch.filter(pa.array(mask)).select([n for n in batch.schema.names if n not in names])

    return map_arrow(df.withColumns(dict(zip(names, extra.values()))), run, df.schema)
