"""Removal of word windows that repeat anywhere in the corpus, by FM-indexes of shards.

1. Every window of ``least`` words has an anchor, its leftmost run of ``GRAM`` words with the
   smallest hash. Windows that follow each other and share their anchor form a segment, so
   each window lies in one segment, and equal windows lie in segments with equal anchors.
2. Segments are sorted by hashes of their anchor and words over range partitions, so a hot
   anchor spreads over tasks. Equal segments collapse to one with a weight; all windows of
   one that occurs twice are repeated. An anchor that has one segment only needs no search.
3. The words of the other segments are fetched, one of equal ones, by a join on the row.
   Documents are stored bucketed by row, so this join, and the last one, move no text.
4. Anchors are dealt to shards. A shard is a compressed FM-index: a wavelet matrix over the
   words before the sorted suffixes, with weights. The segments that occur once stream through
   it backwards; their matching statistics say which windows have a second occurrence.
   Anchors with too many segments are cut by the windows' offsets, into keys with longer shared
   cores; in the end a key is one single window, and grouping alone decides.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import map_arrow, require, slices, text_views
from panelforge.llm.repeat_index import BASES, prefix_sums, range_hashes
from panelforge.llm.wavelet_index import WordIndex
from panelforge.session import land, work_dir

#: Words of an anchor; segments of one anchor that one shard takes; words of a shard, apart from its last anchor's.
GRAM, MOST_SEGMENTS, SHARD_WORDS = 8, 2000, 1 << 17
#: Offsets in a part of a crowded anchor.
PART_OFFSETS = 7
#: Bytes whose words are hashed at a time.
HASH_BYTES = 1 << 20
GAPS = np.zeros(256, dtype=bool)
GAPS[[0x20, *range(0x09, 0x0E)]] = True

PLACES = "gram bigint, content bigint, row bigint, begin int, lead int, windows int"
SEGMENTS = "key bigint, row bigint, begin int, lead int, weight bigint, words binary"
SPANS = "row bigint, begin int, end int"


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word of the texts ``data[bounds[i]:bounds[i+1]]``, and the number of words before each text."""

    low, high = int(bounds[0]), int(bounds[-1])
    solid = ~GAPS[data[low:high]]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    borders = bounds[1:-1] - low
    inner = borders[(borders > 0) & (borders < high - low)]  # a word never crosses a text border
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    begin, end = np.flatnonzero(begins) + low, np.flatnonzero(ends) + low + 1
    return begin, end, np.searchsorted(begin, bounds)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, taken over pieces of the data."""

    out = np.empty(len(begin), dtype=np.uint64)
    at = 0
    while at < len(begin):
        to = max(at + 1, int(np.searchsorted(end, begin[at] + HASH_BYTES, side="right")))
        base = begin[at]
        sums, up = prefix_sums(data[base : end[to - 1]], BASES[0])
        out[at:to] = range_hashes(sums, up, begin[at:to] - base, end[at:to] - base)
        at = to
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(28))


def segments(hashes: np.ndarray, before: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, anchor place, first window and number of windows of each segment of the texts.

    Text i has the words ``before[i]`` to ``before[i+1]``; places count over all words.
    """

    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    if len(hashes) < least:
        return none
    count = len(hashes) - GRAM + 1
    gram = np.zeros(count, dtype=np.uint64)
    for j in range(GRAM):
        gram = gram * np.uint64(0xD6E8FEB86659FD93) + hashes[j : j + count]
    gram = _mixed(gram)
    # Leftmost smallest gram of every window, by doubling.
    width, reach, value, place = least - GRAM + 1, 1, gram, np.arange(count, dtype=np.int32)
    while reach < width:
        step = min(reach, width - reach)
        later = value[step:] < value[:-step]
        place = np.where(later, place[step:], place[:-step])
        value = np.where(later, value[step:], value[:-step])
        reach += step
    window = np.repeat(before[:-1], np.maximum(np.diff(before) - least + 1, 0))
    sizes = np.maximum(np.diff(before) - least + 1, 0)
    window = window + np.arange(len(window)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    if not len(window):
        return none
    anchor = place[window].astype(np.int64)
    heads = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    windows = np.diff(np.append(heads, len(window)))
    return gram[anchor[heads]].view(np.int64), anchor[heads], window[heads], windows


def _content_hashes(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of the words ``first`` to ``last`` of each segment, which are at most ``2 * least`` many."""

    out = np.zeros(len(first), dtype=np.uint64)
    size = last - first
    for j in range(int(size.max()) if len(size) else 0):
        more = np.flatnonzero(size > j)
        out[more] = (out[more] ^ hashes[first[more] + j]) * np.uint64(0xA0761D6478BD642F)
        out[more] ^= out[more] >> np.uint64(32)
    return out.view(np.int64)


def _find_segments(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_views(batch.column(1))
            rows = batch.column(0).to_numpy()
            for low, high in slices(bounds):
                begin, end, before = word_bounds(data, bounds[low : high + 1])
                hashes = word_hashes(data, begin, end)
                gram, anchor, first, windows = segments(hashes, before, least)
                if not len(gram):
                    continue
                text = np.searchsorted(before, first, side="right") - 1
                content = _content_hashes(hashes, first, first + windows + least - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram), pa.array(content), pa.array(rows[low + text]), pa.array((first - before[text]).astype(np.int32)),
                        pa.array((anchor - first).astype(np.int32)), pa.array(windows.astype(np.int32)),
                    ],
                    names=["gram", "content", "row", "begin", "lead", "windows"],
                )

    return run


def _judge_segments(least: int):
    """Spans of repeated segments, and requests for the words of those that must be searched.

    Gets one range of segments sorted by (gram, content, row, begin). Requested is one of each
    content of an anchor that has a content of weight one beside others; at the range's two
    borders, where a neighbour may hold the same anchor, one of each content in any case.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        gram, content, row, begin, lead, windows = (c.to_numpy() for c in table.columns)
        new_gram = np.append(True, gram[1:] != gram[:-1])
        new = new_gram | np.append(True, content[1:] != content[:-1])
        first = np.flatnonzero(new)
        copies = np.diff(np.append(first, len(gram)))
        of = np.cumsum(new_gram)[first] - 1
        single = np.bincount(of, weights=copies == 1)[of] > 0
        wanted = (np.bincount(of)[of] > 1) & single
        wanted |= (of == of[0]) | (of == of[-1])
        requests = first[wanted]
        covered = np.flatnonzero(np.repeat(copies > 1, copies))
        weight = np.concatenate([np.zeros(len(covered), np.int64), copies[wanted]])
        pick = np.concatenate([covered, requests])
        for at in range(0, len(pick), 1 << 16):
            p, w = pick[at : at + (1 << 16)], weight[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(w), pa.array(row[p]), pa.array(begin[p]), pa.array((begin[p] + windows[p] + least - 1).astype(np.int32)),
                    pa.array(gram[p]), pa.array(lead[p]),
                ],
                names=["weight", "row", "begin", "end", "gram", "lead"],
            )

    return run


def _joined_words(data: np.ndarray, begin: np.ndarray, end: np.ndarray, low: int, high: int) -> bytes:
    """The words ``low`` to ``high``, one space between; splitting at white space tells the same words."""

    return b" ".join(data[begin[low] : end[high - 1]].tobytes().split()) if low < high else b""


def _fetch_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the requested segments of each text."""

    for batch in batches:
        data, bounds = text_views(batch.column("text"))
        rows = batch.column("row").to_pylist()
        out = []
        for i, asked in enumerate(batch.column("asked").to_pylist()):
            begin, end, _ = word_bounds(data, bounds[i : i + 2])
            for a in asked:
                words = _joined_words(data, begin, end, a["begin"], a["end"])
                out.append((a["gram"], rows[i], a["begin"], a["lead"], a["weight"], words))
            if len(out) > 1 << 14:
                yield _segment_batch(out)
                out = []
        if out:
            yield _segment_batch(out)


def _segment_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
    names = ["key", "row", "begin", "lead", "weight", "words"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def repeated_windows(texts: list[bytes], weights: list[int], least: int) -> list[np.ndarray]:
    """For each text of words (joined by one space) the places where a repeated window starts.

    All texts are put into one index; those of weight one stream through it. The others'
    windows are known to repeat and are not reported.
    """

    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    begin, end, before = word_bounds(data, bounds)
    _, ids = np.unique(word_hashes(data, begin, end), return_inverse=True)
    count = np.diff(before)
    symbols = np.zeros(len(ids) + len(texts), dtype=np.int64)
    start = before[:-1] + np.arange(len(texts))  # each text is followed by its closing zero
    symbols[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), count)] = ids + 1
    weight = np.array(weights, dtype=np.int64)
    index = WordIndex(symbols, weight, int(count.max()), least)
    once = np.flatnonzero(weight == 1)
    found = index.statistics(start[once], start[once] + count[once]) == least
    return [np.flatnonzero(found[s : s + n]) for s, n in zip(start.tolist(), count.tolist())]


def _search(least: int):
    """Spans of repeated windows of segments, which come sorted by key; keys are searched whole."""

    def spans(held: list[tuple]) -> pa.RecordBatch:
        out = []
        for (_, row, begin, _, _), places in zip(held, repeated_windows([h[4] for h in held], [h[3] for h in held], least)):
            if len(places):
                heads = np.flatnonzero(np.append(True, np.diff(places) > 1))
                tails = np.append(heads[1:], len(places)) - 1
                out += [(row, begin + a, begin + b + least) for a, b in zip(places[heads].tolist(), places[tails].tolist())]
        columns = list(zip(*out)) or [[]] * 3
        kinds = (pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["row", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for item in zip(*(batch.column(n).to_pylist() for n in ("key", "row", "begin", "weight", "words"))):
                if size >= SHARD_WORDS and held[-1][0] != item[0]:
                    yield spans(held)
                    held, size = [], 0
                held.append(item)
                size += item[4].count(b" ") + 2
        if held:
            yield spans(held)

    return run


def _narrow(least: int, step: int):
    """Cut segments by the offset of their windows from the anchor, ``step`` offsets a part.

    All windows at offsets low..high of an anchor contain the words from ``high`` to
    ``low + least``, so these, with the part, are the next key. With one offset a part the
    key is a window; of its words only a digest is kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            names = ("key", "row", "begin", "lead", "weight", "words")
            for key, row, begin, lead, weight, text in zip(*(batch.column(n).to_pylist() for n in names)):
                words = text.split(b" ")
                last = len(words) - least  # windows start at 0..last; their offsets are start - lead
                for part in range(-lead // step, (last - lead) // step + 1):
                    low, high = part * step + lead, part * step + step - 1 + lead
                    first, final = max(low, 0), min(high, last)
                    core = hashlib.blake2b(b"%d %d " % (key, part) + b" ".join(words[high : low + least]), digest_size=16).digest()
                    piece = core if step == 1 else b" ".join(words[first : final + least])
                    out.append((int.from_bytes(core[:8], "little", signed=True), row, begin + first, lead - first, weight, piece))
                if len(out) > 1 << 14:
                    yield _segment_batch(out)
                    out = []
            if out:
                yield _segment_batch(out)

    return run


def _searched_spans(found: DataFrame, least: int, most: int) -> list[DataFrame]:
    """Spans of the repeated windows of stored segments; anchors with more than ``most`` are cut first."""

    def crowded(rows: DataFrame) -> DataFrame:
        return land(rows.groupBy("key").count().where(F.col("count") > most).select("key"), "crowded-anchors")

    def search(rows: DataFrame) -> DataFrame:
        dealt = rows.select("key", "row", "begin", "weight", "words").repartition("key").sortWithinPartitions("key", "row", "begin")
        return land(map_arrow(dealt, _search(least), SPANS), "window-spans")

    crowd = crowded(found)
    spans = [search(found.join(crowd, "key", "left_anti"))]
    if crowd.isEmpty():
        return spans
    parts = land(map_arrow(found.join(crowd, "key", "left_semi"), _narrow(least, PART_OFFSETS), SEGMENTS), "segment-parts")
    crowd = crowded(parts)
    spans.append(search(parts.join(crowd, "key", "left_anti")))
    if crowd.isEmpty():
        return spans
    # One window a row: equal ones are counted, none are compared.
    single = land(map_arrow(parts.join(crowd, "key", "left_semi"), _narrow(least, 1), SEGMENTS), "single-windows")
    often = land(single.groupBy("words").agg(F.sum("weight").alias("n")).where("n > 1").select("words"), "frequent-windows")
    spans.append(
        single.join(often, "words", "left_semi").select("row", "begin", (F.col("begin") + least).cast("int").alias("end"))
    )
    return spans


def stored_by_row(df: DataFrame) -> DataFrame:
    """``df`` with a number ``row`` for each row, stored in buckets of ``row``; joins on it move only the other side."""

    spark = df.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())
    path, name = work_dir(spark, "bucketed-rows"), f"bucketed_rows_{uuid.uuid4().hex}"
    numbered = df.withColumn("row", F.monotonically_increasing_id()).repartition(buckets, "row")
    numbered.write.format("parquet").option("path", path).bucketBy(buckets, "row").saveAsTable(name)
    return spark.table(name)


def repeated_spans(docs: DataFrame, least: int = 35, most: int = MOST_SEGMENTS) -> DataFrame:
    """Spans of words (``row``, ``begin``, ``end``) that together cover the repeated windows; they may overlap.

    ``docs`` is a stored table of ``row``, which names each row once, and ``text``.
    """

    order = ["gram", "content", "row", "begin"]
    places = map_arrow(docs.select("row", "text"), _find_segments(least), PLACES)
    judged = land(
        map_arrow(
            places.repartitionByRange(*order).sortWithinPartitions(*order), _judge_segments(least),
            "weight bigint, row bigint, begin int, end int, gram bigint, lead int",
        ),
        "judged-segments",
    )
    # The requests of one text, no more than its segments.
    asked = judged.where("weight > 0").groupBy("row").agg(F.collect_list(F.struct("begin", "end", "gram", "lead", "weight")).alias("asked"))
    wanted = docs.select("row", "text").join(asked.hint("shuffle_hash"), "row")
    found = land(map_arrow(wanted.select("row", "text", "asked"), _fetch_words, SEGMENTS), "searched-segments")
    spans = judged.where("weight = 0").select("row", "begin", "end")
    for part in _searched_spans(found, least, most):
        spans = spans.unionByName(part)
    return spans


def _cut_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = text_views(batch.column("text"))
        spans = batch.column("spans")
        text_of = np.repeat(np.arange(batch.num_rows), np.diff(spans.offsets.to_numpy()) * np.asarray(spans.is_valid()))
        flat = spans.flatten()
        span_begin, span_end = (flat.field(n).to_numpy().astype(np.int64) for n in ("begin", "end"))
        rows = []
        for low, high in slices(bounds):
            begin, end, before = word_bounds(data, bounds[low : high + 1])
            own = slice(*np.searchsorted(text_of, [low, high]))
            shift = before[text_of[own] - low]
            change = np.zeros(len(begin) + 1, dtype=np.int64)
            np.add.at(change, shift + span_begin[own], 1)
            np.add.at(change, shift + span_end[own], -1)
            gone = np.cumsum(change[:-1]) > 0
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[before])
            for i, (a, b, n) in enumerate(zip(before[:-1].tolist(), before[1:].tolist(), removed.tolist())):
                if n:
                    kept = ~gone[a:b]
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], kept, [False]]))) + a
                    pieces = [_joined_words(data, begin, end, p, q) for p, q in zip(edges[::2].tolist(), edges[1::2].tolist())]
                    text = b" ".join(pieces)
                else:
                    text = _joined_words(data, begin, end, a, b)
                rows.append((b - a, n, hashlib.sha256(text).hexdigest()))
        columns = list(zip(*rows)) or [[]] * 3
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
            names=["id", "n_words", "n_removed", "kept_sha256"],
        )


def remove_repeated_windows(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = 35, most: int = MOST_SEGMENTS
) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_removed``, ``kept_sha256`` of the kept words joined by one space.

    A word goes if it lies in a window of ``least`` words whose words also start anywhere
    else, in the same or another text; windows are judged on the input. Words are what stands
    between spaces, tabs and line ends. Null counts as empty; texts of fewer words stay
    whole; repeated rows repeat each other; null ids are ids like any other. An empty table
    gives an empty result. Other columns are ignored. Words are compared by 64-bit hashes.
    """

    require(df, id_column, text_column)
    if least <= GRAM:
        raise ValueError(f"least must exceed {GRAM}")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    docs = stored_by_row(df.select(F.col(id_column).alias("id"), text.alias("text")))
    spans = repeated_spans(docs, least, most).groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))  # of one text
    kind = df.schema[id_column].dataType.simpleString()
    joined = docs.join(spans.hint("shuffle_hash"), "row", "left").select("id", "text", "spans")
    schema = f"id {kind}, n_words bigint, n_removed bigint, kept_sha256 string"
    return map_arrow(joined, _cut_words, schema).withColumnRenamed("id", id_column)
