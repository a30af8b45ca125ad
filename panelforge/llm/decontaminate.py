"""Benchmark decontamination by q-gram lemma filtering.

A window of an item starts at each of its characters. A window of n characters that
occurs in a text with at most k edits shares at least n + 1 - q(k + 1) of its q-grams
with the text, all on at most k + 1 neighbouring diagonals (text position minus
item position). So the q-grams that text and item share are counted in overlapping
bands of diagonals, two such widths wide and one apart: every possible occurrence
lies whole in some band. In bands that reach the bound, the windows that reach it by
themselves are verified by an alignment inside the band, which is exact for them.

The benchmark is the query set. It goes to the executors in blocks of bounded
size, one pass over the texts per block, so neither table is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from panelforge.llm.common import filter_rows, map_arrow, require
from panelforge.session import land

#: Characters of a q-gram, of a window (13 words are about 75); edits per character of a window.
Q, WINDOW, EDIT_SHARE = 10, 75, 0.08
#: Characters of the q-grams that sift windows before their alignment.
SHORT_Q = 5
#: Items of fewer normalised characters match verbatim only.
VERBATIM_BELOW = 24
#: Default of the least normalised characters of an item that is searched for: those of one q-gram.
LEAST_CHARS = Q
#: Characters of benchmark text in one block, and of corpus text in one vectorised step.
BLOCK_CHARS, STEP_CHARS = 2_000_000, 1 << 19
#: Shared q-grams that one step expands at a time.
STEP_HITS = 2_000_000
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
FILTER_BITS = 22


def normalise(text: str | None) -> str:
    """Lower case, with every run of white space as one space; null is empty."""

    return " ".join((text or "").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")


@lru_cache(maxsize=2)
def _power_table(count: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = (np.full(count, b, dtype=np.uint64) for b in (BASE, inverse))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below ``count``."""

    up, down = _power_table(1 << max(STEP_CHARS + 1, count).bit_length())
    return up[:count], down[:count]


def _grams(codes: np.ndarray) -> np.ndarray:
    """A hash of the q-gram that starts at each position; equal q-grams have equal hashes."""

    if len(codes) < Q:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(len(codes))
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * down, out=sums[1:])
    h = (sums[Q:] - sums[:-Q]) * up[: len(codes) - Q + 1]  # the same at every place
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Index:
    """One block of items and the postings of their q-grams, one for each place."""

    numbers: np.ndarray  # item numbers of the texts
    texts: np.ndarray  # characters of all texts
    starts: np.ndarray  # bounds of the texts in it
    k: np.ndarray  # edits that a window of the text may have
    length: np.ndarray  # of a window of the text
    seen: np.ndarray  # quick filter on hash bits
    grams: np.ndarray
    first: np.ndarray
    count: np.ndarray
    text: np.ndarray
    place: np.ndarray

    @property
    def windows(self) -> np.ndarray:
        """Number of the first window of each text, and of all windows."""

        return np.concatenate([[0], np.cumsum(np.diff(self.starts) - self.length + 1)])

    @property
    def bound(self) -> np.ndarray:
        return self.length + 1 - Q * (self.k + 1)

    @property
    def items(self) -> np.ndarray:
        """Item number of each window."""

        return np.repeat(self.numbers, np.diff(self.windows))

    @property
    def edits(self) -> np.ndarray:
        return np.repeat(self.k, np.diff(self.windows))

    @property
    def codes(self) -> list[np.ndarray]:
        bounds = zip(self.starts[:-1], np.diff(self.windows), self.length)
        return [self.texts[a + s : a + s + n] for a, number, n in bounds for s in range(number)]


def build_index(texts: list[str], least_chars: int = LEAST_CHARS) -> Index | None:
    """Index normalised item texts of ``least_chars`` characters, at least ``Q``; None if there are none."""

    if least_chars < Q:
        raise ValueError(f"an item needs the {Q} characters of a q-gram")
    numbers = np.array([i for i, t in enumerate(texts) if len(t) >= least_chars], dtype=np.int64)
    if not len(numbers):
        return None
    codes = [_codes(texts[i]) for i in numbers]
    sizes = np.array([len(c) for c in codes], dtype=np.int64)
    length = np.minimum(sizes, WINDOW)
    edits = np.minimum((EDIT_SHARE * length).astype(np.int64), length // Q - 1)
    edits[length < VERBATIM_BELOW] = 0
    hashes = [_grams(c) for c in codes]
    grams = np.concatenate(hashes)
    text = np.repeat(np.arange(len(codes)), [len(h) for h in hashes])
    place = np.concatenate([np.arange(len(h)) for h in hashes])
    order = np.argsort(grams, kind="stable")
    unique, first, count = np.unique(grams[order], return_index=True, return_counts=True)
    seen = np.zeros(1 << FILTER_BITS, dtype=bool)
    seen[unique >> np.uint64(64 - FILTER_BITS)] = True
    return Index(
        numbers, np.concatenate(codes), np.concatenate([[0], np.cumsum(sizes)]), edits, length, seen, unique, first,
        count, text[order], place[order],
    )


def _bands(index: Index, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, item text, window start, band) of the windows whose shared q-grams reach the bound."""

    none = (np.zeros(0, np.int64),) * 4
    grams = _grams(codes)
    at = np.flatnonzero(index.seen[grams >> np.uint64(64 - FILTER_BITS)])
    near = np.minimum(np.searchsorted(index.grams, grams[at]), len(index.grams) - 1)
    same = index.grams[near] == grams[at]
    at, near = at[same], near[same]
    text = np.searchsorted(bounds, at, side="right") - 1
    whole = at + Q <= bounds[text + 1]  # not across a text border
    at, near, text = at[whole], near[whole], text[whole]
    if not len(at):
        return none
    longest = int(np.diff(index.starts).max())
    items = len(index.numbers)
    most_bands = int(np.diff(bounds).max() + longest) + 2
    total = np.cumsum(index.count[near])
    cuts = np.searchsorted(total, np.arange(0, total[-1] + STEP_HITS, STEP_HITS))
    steps = [(low, high) for low, high in zip(cuts[:-1], np.append(cuts[1:-1], len(at))) if low < high]

    def expand(low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Key of (text, item, band) and item place of each hit, in both bands that hold its diagonal."""

        n = index.count[near[low:high]]
        hit = np.repeat(np.arange(low, high), n)
        nth = np.arange(len(hit)) - np.repeat(np.cumsum(n) - n, n)
        posting = index.first[near[hit]] + nth
        item, place = index.text[posting], index.place[posting]
        band = (at[hit] - bounds[text[hit]] - place + longest) // (index.k[item] + 1)
        key = (text[hit] * items + item) * most_bands + band
        return np.concatenate([key, key - 1]), np.concatenate([place, place])

    counted = [np.unique(expand(*step)[0], return_counts=True) for step in steps]
    found, inverse = np.unique(np.concatenate([f for f, _ in counted]), return_inverse=True)
    number = np.bincount(inverse, weights=np.concatenate([n for _, n in counted]))
    found = found[number >= index.bound[found // most_bands % items]]
    if not len(found):
        return none
    # The hits of the bands that are left, by place: a window needs enough of them inside.
    keys, places = [], []
    for step in steps:
        key, place = expand(*step)
        slot = np.minimum(np.searchsorted(found, key), len(found) - 1)
        left = found[slot] == key
        keys.append(slot[left])
        places.append(place[left])
    key, place = np.concatenate(keys), np.concatenate(places)
    order = np.lexsort((place, key))
    key, place = key[order], place[order]
    item = found // most_bands % items
    last = np.arange(len(key)) + index.bound[item[key]] - 1
    inside = last < len(key)
    first, last = np.flatnonzero(inside), last[inside]
    k = key[first]
    reach = index.length[item[k]] - Q
    enough = (key[last] == k) & (place[last] - place[first] <= reach)
    first, last, k, reach = first[enough], last[enough], k[enough], reach[enough]
    # A window that starts at ``low``..``high`` holds these hits; each start is taken once.
    low = np.maximum(place[last] - reach, 0)
    high = np.minimum(place[first], (np.diff(index.starts) - index.length)[item[k]])
    new = np.append(True, k[1:] != k[:-1])
    low[1:] = np.where(new[1:], low[1:], np.maximum(low[1:], high[:-1] + 1))  # both bounds rise within a key
    n = np.maximum(high - low + 1, 0)
    k, start = np.repeat(k, n), np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return found[k] // most_bands // items, item[k], start, found[k] % most_bands


def _align(
    index: Index, codes: np.ndarray, bounds: np.ndarray, text: np.ndarray, item: np.ndarray, begin: np.ndarray,
    band: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edits of each window inside its band, or any number above its bound, with begin and end of that occurrence.

    Distance and begin are packed into one integer, so a minimum takes the least
    distance and, among those, the earliest begin. Rows of the arrays are columns of
    the band, so that each step works on all windows at once.
    """

    best = np.zeros((3, len(item)), dtype=np.int64)
    longest = int(np.diff(index.starts).max())
    for size in np.unique(index.length[item]):
        chosen = np.flatnonzero(index.length[item] == size)
        edits = int(index.k[item[chosen[0]]])
        width = 2 * (edits + 1)
        one = np.int16(1 << width.bit_length())  # an edit; below it the begin, counted from the band's first column
        far = np.int16(min(1 << 14, one * (size + width)))
        for rows in np.array_split(chosen, -(-len(chosen) // 4096)):
            pattern = index.texts[(index.starts[item[rows]] + begin[rows])[None, :] + np.arange(size)[:, None]]
            length = bounds[text[rows] + 1] - bounds[text[rows]]
            base = band[rows] * (edits + 1) - longest + begin[rows]
            column = base[None, :] + np.arange(size + width)[:, None]
            outside = np.where((column >= 0) & (column <= length), np.int16(0), far)
            char = codes[np.clip(bounds[text[rows]] + column, 0, len(codes) - 1)]
            # Verbatim windows need no alignment; the first of the band's diagonals begins earliest. Nor do
            # windows that miss the lemma's bound for shorter q-grams, of which some diagonal must hold enough.
            verbatim = np.full(len(rows), -1)
            held = np.zeros((size + 1 - SHORT_Q, len(rows)), dtype=bool)
            for j in range(width - 1, -1, -1):
                same = char[j : j + size] == pattern
                verbatim[(outside[j] == 0) & (outside[j + size] == 0) & same.all(axis=0)] = j
                gram = same[: len(held)].copy()
                for i in range(1, SHORT_Q):
                    gram &= same[i : i + len(held)]
                held |= gram
            known = verbatim >= 0
            done, first = rows[known], base[known] + verbatim[known]
            best[1, done], best[2, done] = first, first + size
            best[0, rows[~known]] = edits + 1  # unless the alignment finds fewer
            left = ~known & (held.sum(axis=0) >= size + 1 - SHORT_Q * (edits + 1))
            if not left.any():
                continue
            rows, base, pattern, char, outside = (v[..., left] for v in (rows, base, pattern, char, outside))
            cell = np.maximum(np.arange(width, dtype=np.int16)[:, None], outside[:width])
            for r in range(1, size + 1):
                step = cell + (char[r - 1 : r - 1 + width] != pattern[r - 1]) * one
                step[:-1] = np.minimum(step[:-1], cell[1:] + one)
                step = np.maximum(step, outside[r : r + width])
                for j in range(1, width):
                    np.minimum(step[j], step[j - 1] + one, out=step[j])
                cell = np.minimum(step, far)
            where = cell.argmin(axis=0)
            final = cell[where, np.arange(len(rows))].astype(np.int64)
            best[0, rows], best[1, rows], best[2, rows] = final // one, base + final % one, base + where + size
    return best[0], best[1], best[2]


def matches(index: Index | None, texts: list[str | None]) -> dict[str, np.ndarray]:
    """Verified (text, item) pairs: windows found, least edits, begin and end in the normalised text."""

    names = ("text", "item", "windows", "edits", "begin", "end")
    parts: list[np.ndarray] = []
    low = 0
    while index is not None and low < len(texts):
        cleaned, size, high = [], 0, low
        while high < len(texts) and (high == low or size < STEP_CHARS):
            cleaned.append(normalise(texts[high]))
            size += len(cleaned[-1])
            high += 1
        codes = _codes("".join(cleaned))
        bounds = np.concatenate([[0], np.cumsum([len(c) for c in cleaned])]).astype(np.int64)
        text, item, start, band = _bands(index, codes, bounds)
        if len(text):
            edits, begin, end = _align(index, codes, bounds, text, item, start, band)
            ok = edits <= index.k[item]
            w = index.windows[item[ok]] + start[ok]
            parts.append(np.stack([text[ok] + low, index.numbers[item[ok]], w, edits[ok], begin[ok], end[ok]]))
        low = high
    if not parts or not sum(p.shape[1] for p in parts):
        return {n: np.zeros(0, np.int64) for n in names}
    text, item, w, edits, begin, end = np.concatenate(parts, axis=1)
    order = np.lexsort((w, item, text))
    text, item, w, edits, begin, end = (v[order] for v in (text, item, w, edits, begin, end))
    new = np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]))
    cut = np.flatnonzero(new)
    fresh = np.append(True, new[1:] | (w[1:] != w[:-1])).astype(np.int64)
    return dict(
        zip(
            names,
            (
                text[cut], item[cut], np.add.reduceat(fresh, cut), np.minimum.reduceat(edits, cut),
                np.minimum.reduceat(begin, cut), np.maximum.reduceat(end, cut),
            ),
        )
    )


def item_blocks(benchmark: DataFrame, item_column: str, text_column: str) -> Iterator[tuple[list, list[str]]]:
    """Items and normalised texts in blocks of about ``BLOCK_CHARS``, one after the other."""

    rows: Iterable = benchmark.select(item_column, F.col(text_column).cast("string")).toLocalIterator()
    ids, texts, size = [], [], 0
    for item, text in rows:
        ids.append(item)
        texts.append(normalise(text))
        size += len(texts[-1])
        if size >= BLOCK_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text", least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """One row per (document row, benchmark item) with a window of the item in the document.

    Columns: the document's id, the item's id, ``windows`` found, least ``edits``, and
    ``begin`` and ``end`` (characters of the normalised text) around all of them. Texts are
    compared in lower case with white space collapsed. Null, empty and clean texts give no
    row; an item shorter than ``least_chars`` is not searched for, and one shorter than
    ``VERBATIM_BELOW`` matches without an edit only; repeated rows and items each give their own
    rows; an empty table gives an empty result. Both tables may have any other columns, of any
    names. The rows of every block but the last are stored before the next block is indexed.
    """

    require(docs, id_column, text_column)
    require(benchmark, item_column, item_text_column)
    kinds = docs.schema[id_column].dataType.simpleString(), benchmark.schema[item_column].dataType.simpleString()
    schema = f"doc {kinds[0]}, item {kinds[1]}, windows int, edits int, begin int, end int"
    picked = docs.select(F.col(id_column).alias("doc"), F.col(text_column).cast("string").alias("text"))

    def search(ids: list, texts: list[str]):
        index = build_index(texts, least_chars)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = matches(index, batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(found["text"])), pa.array([ids[i] for i in found["item"]], item_type)]
                    + [pa.array(found[n], pa.int32()) for n in ("windows", "edits", "begin", "end")],
                    names=["doc", "item", "windows", "edits", "begin", "end"],
                )

        return run

    item_type = to_arrow_type(benchmark.schema[item_column].dataType)
    parts: list[DataFrame] = []
    for ids, texts in item_blocks(benchmark, item_column, item_text_column):
        if parts:  # cuts the plan, and with it the index it holds
            parts[-1] = land(parts[-1], "benchmark-passages")
        parts.append(map_arrow(picked, search(ids, texts), schema))
    found = reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], schema)
    return found.toDF(id_column, item_column if item_column != id_column else f"{item_column}_item", *found.columns[2:])


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_text_column: str = "text",
    least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """The rows without any benchmark passage, with all columns of ``docs``.

    What every block but the last leaves is stored before the next block is indexed.
    """

    require(docs, text_column)
    require(benchmark, item_text_column)
    kept = docs
    item = next((c for c in benchmark.columns if c != item_text_column), item_text_column)
    for number, (_, texts) in enumerate(item_blocks(benchmark, item, item_text_column)):
        if number:
            kept = land(kept, "clean-documents")
        index = build_index(texts, least_chars)

        def clean(text: pa.Array, index: Index | None = index) -> np.ndarray:
            mask = np.ones(len(text), dtype=bool)
            mask[matches(index, text.to_pylist())["text"]] = False
            return mask

        kept = filter_rows(kept, {"text": F.col(text_column).cast("string")}, clean)
    return kept
