"""Removal of byte passages that repeat anywhere in the corpus.

A common-prefix interval tree of an enhanced suffix array yields the maximal
repeats (:func:`panelforge.llm.repeat_index.maximal_repeats`). To build it only
where repeats can be, and in pieces that fit a task:

1. Every stretch of ``least`` bytes has an anchor, a short string chosen by its
   content, so equal stretches have equal anchors at equal offsets. An anchor's
   context is all the bytes of the stretches around it.
2. Anchors are sorted by (anchor, context) hashes over range partitions, so a hot
   anchor spreads over tasks. A context that occurs twice is covered whole. Only
   contexts that occur once, but whose anchor also stands in another context, need
   their bytes: they straddle the ends of repeats.
3. The bytes of those contexts are fetched by a second scan of the texts. A bit set
   of fixed size tells the scan which anchors are wanted; a false hit costs time only.
4. Contexts meet by anchor. A suffix array over the contexts of an anchor, and the
   scan of its interval tree, give the maximal repeats, and these the covered bytes.
   Anchors with too many contexts are cut into narrower ones first: a stretch at
   offsets lo..hi from the anchor shares a longer core, which is the next key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import map_arrow, numbered, require, text_views
from panelforge.llm.repeat_index import BASES, anchors, maximal_repeats, prefix_sums, range_hashes
from panelforge.session import land

#: Bytes of an anchor; contexts that one suffix array takes; bits of the set of wanted anchors (32 MB).
GRAM, MOST_CONTEXTS, WANTED_BITS = 40, 4000, 28
#: Bytes of contexts that are put into one suffix array, together with whole further anchors.
ARRAY_BYTES = 1 << 18

PLACES = "gram bigint, context bigint, row bigint, at bigint, before int, after int"
CONTEXTS = "key bigint, row bigint, start bigint, anchor int, low int, high int, bytes binary"
SPANS = "row bigint, begin bigint, end bigint"


def _places_of(data: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Anchor places of one text with their two hashes and the reach of their contexts."""

    at, gram = anchors(data, least, GRAM)
    before = np.minimum(at, least - GRAM)
    after = np.minimum(len(data) - at, least)
    sums, up = prefix_sums(data, BASES[1])
    context = range_hashes(sums, up, at - before, at + after) ^ before.astype(np.uint64)
    return gram.view(np.int64), context.view(np.int64), at, before, after


def _find_places(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_views(batch.column(1))
            rows = batch.column(0).to_numpy()
            parts, size = [], 0
            for i in np.flatnonzero(np.diff(bounds) >= least):
                found = _places_of(data[bounds[i] : bounds[i + 1]], least)
                parts.append((found[0], found[1], np.full(len(found[2]), rows[i]), found[2], found[3], found[4]))
                size += len(found[2])
                if size >= 1 << 16:
                    yield _batch(parts)
                    parts, size = [], 0
            if parts:
                yield _batch(parts)

    return run


def _batch(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*parts)]
    kinds = (np.int64, np.int64, np.int64, np.int64, np.int32, np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(c.astype(k)) for c, k in zip(columns, kinds)],
        names=["gram", "context", "row", "at", "before", "after"],
    )


def _judge_places(least: int):
    """Spans of repeated contexts, and requests for the bytes of contexts that differ around one anchor.

    Gets one range of anchors sorted by (gram, context, row, at). At its two borders a
    neighbour may hold the same anchor, so there one of each context is requested in any case.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        gram, context, row, at, before, after = (c.to_numpy() for c in table.columns)
        size = len(gram)
        new_gram = np.append(True, gram[1:] != gram[:-1])
        first = np.flatnonzero(new_gram | np.append(True, context[1:] != context[:-1]))
        copies = np.diff(np.append(first, size))
        whole = np.repeat(copies >= 2, copies) & (before + after >= least)
        gram_of = np.cumsum(new_gram)[first] - 1
        contexts = np.bincount(gram_of)[gram_of]
        single = np.bincount(gram_of, weights=copies == 1)[gram_of] > 0
        wanted = (contexts >= 2) & single
        wanted |= (gram_of == gram_of[0]) | (gram_of == gram_of[-1])
        wanted = first[wanted]
        covered = np.flatnonzero(whole)
        kind = np.concatenate([np.zeros(len(covered), bool), np.ones(len(wanted), bool)])
        pick = np.concatenate([covered, wanted])
        for low in range(0, len(pick), 1 << 16):
            p, k = pick[low : low + (1 << 16)], kind[low : low + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(k), pa.array(row[p]), pa.array(np.where(k, at[p], at[p] - before[p])),
                    pa.array(np.where(k, 0, at[p] + after[p])),
                ],
                names=["request", "row", "begin", "end"],
            )

    return run


def _bit(row: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
    h = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + at.astype(np.uint64)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(32))) >> np.uint64(64 - bits)


def _wanted_set(requests: DataFrame) -> np.ndarray:
    """The wanted places as a bit set of at most ``2 ** WANTED_BITS`` bits, packed in bytes.

    Each task reduces its places to bits; the driver gets the words that are not zero,
    so at most ``2 ** (WANTED_BITS - 6)`` rows.
    """

    count = requests.count()
    bits = int(min(WANTED_BITS, max(10, np.ceil(np.log2(max(count, 1) * 16)))))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = _bit(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((place >> np.uint64(6)).astype(np.int64)),
                    pa.array((np.uint64(1) << (place & np.uint64(63))).view(np.int64)),
                ],
                names=["word", "mask"],
            )

    words = map_arrow(requests.select("row", F.col("begin").alias("at")), reduce, "word bigint, mask bigint")
    table = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    packed = np.zeros(1 << max(0, bits - 6), dtype=np.uint64)
    packed[table.column("word").to_numpy()] = table.column("mask").to_numpy().view(np.uint64)
    return packed


def _fetch_contexts(packed: np.ndarray, least: int):
    bits = 6 + int(np.log2(len(packed)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_views(batch.column(1))
            rows = batch.column(0).to_numpy()
            out: list[tuple] = []
            size = 0
            for i in np.flatnonzero(np.diff(bounds) >= least):
                text = data[bounds[i] : bounds[i + 1]]
                at, gram = anchors(text, least, GRAM)
                place = _bit(np.full(len(at), rows[i]), at, bits)
                hit = (packed[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) > 0
                for a, g in zip(at[hit].tolist(), gram[hit].view(np.int64).tolist()):
                    begin = max(0, a - (least - GRAM))
                    piece = text[begin : a + least].tobytes()
                    if len(piece) >= least:
                        out.append((g, int(rows[i]), begin, a - begin, 0, least - GRAM, piece))
                        size += len(piece)
                if size >= 4 << 20:
                    yield _context_batch(out)
                    out, size = [], 0
            if out:
                yield _context_batch(out)

    return run


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    names = ["key", "row", "start", "anchor", "low", "high", "bytes"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _repeat_spans(least: int):
    """Covered spans of contexts, which come sorted by key; keys are processed whole."""

    def spans(held: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        texts = [h[3] for h in held]
        bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        change = np.zeros(bounds[-1] + 1, dtype=np.int64)
        for length, places in maximal_repeats(texts, least, [(h[1], h[2]) for h in held]):
            where = bounds[[t for t, _ in places]] + np.array([p for _, p in places])
            np.add.at(change, where, 1)
            np.add.at(change, where + length, -1)
        covered = np.concatenate([[False], np.cumsum(change) > 0, [False]])
        begin = np.flatnonzero(~covered[:-1] & covered[1:])
        end = np.flatnonzero(covered[:-1] & ~covered[1:])
        text = np.searchsorted(bounds, begin, side="right") - 1
        row = np.array([h[1] for h in held], dtype=np.int64)[text]
        shift = np.array([h[2] for h in held], dtype=np.int64)[text] - bounds[text]
        return pa.RecordBatch.from_arrays(
            [pa.array(row), pa.array(begin + shift), pa.array(end + shift)], names=["row", "begin", "end"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size = 0
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("key", "row", "start", "bytes")]
            for item in zip(*columns):
                if size >= ARRAY_BYTES and held[-1][0] != item[0]:
                    yield spans(held)
                    held, size = [], 0
                held.append(item)
                size += len(item[3])
        if held:
            yield spans(held)

    return run


def _narrow(least: int):
    """Cut contexts in two by the offset of a stretch's start from the anchor.

    A stretch that starts ``o`` bytes before the anchor, low <= o <= high, covers the core
    [-low, least - high) and lies in [-high, least - low). The core's hash is the next key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "row", "start", "anchor", "low", "high", "bytes"]
        for batch in batches:
            out, contents = [], []
            for key, row, start, anchor, low, high, data in zip(*[batch.column(n).to_pylist() for n in names]):
                for part in np.array_split(np.arange(low, high + 1), min(2, high - low + 1)):
                    a, b = int(part[0]), int(part[-1])
                    core = data[max(0, anchor - a) : anchor + least - b]
                    if anchor < a or len(core) < least - b + a:
                        continue  # no stretch at these offsets fits into the text
                    begin = max(0, anchor - b)
                    content = data[begin : anchor + least - a]
                    digest = hashlib.blake2b(core, digest_size=8, salt=b"%d-%d" % (a, b)).digest()
                    out.append((int.from_bytes(digest, "little", signed=True), row, start + begin, anchor - begin, a, b, content))
                    whole = hashlib.blake2b(content, digest_size=8, key=digest, salt=b"%d" % (anchor - begin)).digest()
                    contents.append(int.from_bytes(whole, "little", signed=True))
            if out:
                cut = _context_batch(out)
                yield pa.RecordBatch.from_arrays(
                    [*cut.columns, pa.array(contents, pa.int64())], names=[*cut.schema.names, "content"]
                )

    return run


def _spans_of(contexts: DataFrame, least: int) -> list[DataFrame]:
    """Covered spans from contexts that meet by key; crowded keys are narrowed until they fit.

    A stretch reaches far to one side of its anchor at least, so a cut in two already parts
    most contexts. Every round makes two rows at most of a context, and only of those whose
    key still is crowded. The offsets halve each time, so a key soon stands for one single
    stretch (after eight rounds for 200 bytes), and the loop ends.
    """

    found = []
    contexts = land(contexts, "repeat-contexts")
    while True:
        crowded = land(
            contexts.groupBy("key").count().where(F.col("count") > MOST_CONTEXTS).select("key"), "crowded-anchors"
        )
        fitting = contexts.join(crowded, "key", "left_anti")
        found.append(
            land(
                map_arrow(
                    fitting.select("key", "row", "start", "bytes").repartition("key").sortWithinPartitions("key", "row", "start"),
                    _repeat_spans(least), SPANS,
                ),
                "repeat-spans",
            )
        )
        if crowded.isEmpty():
            return found
        crowd = contexts.join(crowded, "key", "left_semi")
        cut = land(map_arrow(crowd, _narrow(least), f"{CONTEXTS}, content bigint"), "narrowed-contexts")
        # Equal contents are covered whole; one of them stays as a partner for the others.
        copies = land(
            cut.groupBy("key", "content").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "start")).alias("one")),
            "content-copies",
        )
        shared = cut.join(copies.where("n > 1").select("key", "content"), ["key", "content"], "left_semi")
        end = F.col("start") + F.length("bytes")
        found.append(
            land(
                shared.where(F.length("bytes") >= least).select("row", F.col("start").alias("begin"), end.alias("end")),
                "repeat-spans",
            )
        )
        one = copies.select("key", "content", "one.row", "one.start")
        lone = cut.where("low < high").join(one, ["key", "content", "row", "start"], "left_semi")
        contexts = land(lone.select("key", "row", "start", "anchor", "low", "high", "bytes"), "repeat-contexts")


def repeated_spans(docs: DataFrame, least: int = 200) -> DataFrame:
    """Spans (``row``, ``begin``, ``end``) that together cover exactly the repeated bytes; they may overlap.

    ``docs`` is a stored table of ``row``, which names each row once, and ``text``.
    """

    order = ["gram", "context", "row", "at"]
    places = map_arrow(docs, _find_places(least), PLACES)
    judged = land(
        map_arrow(
            places.repartitionByRange(*order).sortWithinPartitions(*order), _judge_places(least),
            "request boolean, row bigint, begin bigint, end bigint",
        ),
        "judged-anchors",
    )
    spans = judged.where(~F.col("request")).select("row", "begin", "end")
    requests = judged.where("request")
    contexts = map_arrow(docs, _fetch_contexts(_wanted_set(requests), least), CONTEXTS)
    for part in _spans_of(contexts, least):
        spans = spans.unionByName(part)
    return spans


def _cut_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = text_views(batch.column("text"))
        rows = []
        for i, spans in enumerate(batch.column("spans").to_pylist()):
            text = data[bounds[i] : bounds[i + 1]].tobytes()
            kept, at, removed, runs = hashlib.sha256(), 0, 0, 0
            for s in sorted(spans or [], key=lambda s: (s["begin"], s["end"])):
                if s["begin"] > at or not runs:
                    runs += 1
                    kept.update(text[at : s["begin"]])
                    at = s["begin"]
                removed += max(0, s["end"] - at)
                at = max(at, s["end"])
            kept.update(text[at:])
            rows.append((len(text), removed, runs, kept.hexdigest()))
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def remove_repeats(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = 200
) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    Every byte that lies in a string of ``least`` bytes which also starts elsewhere, in the
    same or another text, is removed; strings are judged on the input. Texts are UTF-8; null
    counts as empty; texts shorter than ``least`` stay whole; repeated rows repeat each
    other. An empty table gives an empty result. The numbered rows are stored once; all
    scans use those numbers. Other columns are ignored.
    """

    require(df, id_column, text_column)
    if least <= GRAM:
        raise ValueError(f"least must exceed {GRAM}")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    docs = numbered(df.select(F.col(id_column).alias("id"), text.alias("text")), "row")
    spans = (
        repeated_spans(docs.select("row", "text"), least)
        .groupBy("row")
        .agg(F.collect_set(F.struct("begin", "end")).alias("spans"))  # those of one text
    )
    kind = df.schema[id_column].dataType.simpleString()
    joined = docs.join(land(spans, "text-spans"), "row", "left").select("id", "text", "spans")
    return map_arrow(
        joined, _cut_spans, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    ).withColumnRenamed("id", id_column)
