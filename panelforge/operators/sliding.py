"""Count, mean and squared deviations over sliding day windows, by merging blocks of rows.

The functions that run on executors are closures over numpy and pyarrow alone, so a worker
needs nothing of this package.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

#: Rows that are worked on together, apart from the last key's.
CHUNK_ROWS = 1 << 16


def window_deviations(windows: Sequence[int], least: int, scale: float) -> Callable:
    """A function over Arrow batches (key, day, value), sorted by key and day: one row per input row and window.

    Rows come out as key, day, ``window_days``, ``observations`` and the standard deviation of
    the non-null values in the ``window_days`` calendar days that end at the row's day, times
    ``scale``; null below ``least`` values.

    The (count, mean, squared deviations) of neighbouring blocks merge without cancellation.
    Blocks of 1, 2, 4 ... rows that end at each row are built one from the other, and the rows
    of a window are the blocks of its length's binary digits. That is a logarithm of its rows in
    work, no sum over a whole history is ever subtracted, and days without rows cost nothing.
    """

    chunk_rows = CHUNK_ROWS

    def merged(a: tuple, b: tuple) -> tuple:
        count = a[0] + b[0]
        share = np.divide(b[0], count, out=np.zeros(len(count)), where=count > 0)
        delta = b[1] - a[1]
        return count, a[1] + delta * share, a[2] + b[2] + delta * delta * a[0] * share

    def deviations(new_key: np.ndarray, day: np.ndarray, value: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = len(day)
        first = np.maximum.accumulate(np.where(new_key, np.arange(size), 0))  # of the row's key
        # Days of one number line on which keys lie further apart than any window reaches.
        gap = int(day.max() - day.min()) + max(windows) + 1
        line = day + np.cumsum(new_key) * gap
        place = np.arange(size)
        begin = [np.maximum(np.searchsorted(line, line - w, side="right"), first) for w in windows]
        rows = np.concatenate([place + 1 - b for b in begin])  # rows in each window
        end = np.tile(place, len(windows))  # last row that is still to be added
        zero = np.zeros(len(rows))
        total = (zero, zero.copy(), zero.copy())
        block = (known.astype(float), np.where(known, value, 0.0), np.zeros(size))
        reach = 1
        while True:
            pick = np.flatnonzero(rows & reach)
            part = merged(tuple(t[pick] for t in total), tuple(b[end[pick]] for b in block))
            for t, p in zip(total, part):
                t[pick] = p
            end[pick] -= reach
            reach *= 2
            if reach > int(rows.max()):
                break
            # Blocks twice as long; those that would begin before the first row are never asked for.
            longer = merged(tuple(b[: size - reach // 2] for b in block), tuple(b[reach // 2 :] for b in block))
            block = tuple(np.concatenate([b[: reach // 2], n]) for b, n in zip(block, longer))
        count, _, squares = total
        enough = count >= max(least, 2)
        result = np.sqrt(np.divide(squares, count - 1, out=np.full(len(count), np.nan), where=enough)) * scale
        in_rows = (len(windows), size)
        return count.astype(np.int64).reshape(in_rows).T.ravel(), result.reshape(in_rows).T.ravel()

    def measured(table: pa.Table) -> pa.RecordBatch:
        keys, days, values = (c.combine_chunks() for c in table.columns)
        code = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
        new_key = np.append(True, code[1:] != code[:-1])
        day = days.cast(pa.int32()).to_numpy().astype(np.int64)
        known = np.asarray(values.is_valid())
        value = values.fill_null(0.0).to_numpy()
        count, deviation = deviations(new_key, day, value, known)
        source = pa.array(np.repeat(np.arange(len(day)), len(windows)))
        return pa.RecordBatch.from_arrays(
            [
                keys.take(source), days.take(source), pa.array(np.tile(np.array(windows, dtype=np.int32), len(day))),
                pa.array(count), pa.array(deviation, mask=np.isnan(deviation)),
            ],
            names=[*table.schema.names[:2], "window_days", "observations", "volatility"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            if held.num_rows < chunk_rows:
                continue
            keys = held.column(0).combine_chunks()
            code = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
            heads = np.flatnonzero(code[1:] != code[:-1]) + 1
            if len(heads):  # the last key may go on
                yield measured(held.slice(0, int(heads[-1])))
                held = held.slice(int(heads[-1]))
        if held is not None and held.num_rows:
            yield measured(held)

    return run
