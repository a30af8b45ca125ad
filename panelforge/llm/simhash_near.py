"""Near-duplicate groups by SimHash and meet-in-the-middle ball hashing.

Two fingerprints differ in at most two bits exactly when some bit string lies
within one bit of both. Every distinct fingerprint therefore emits itself and
its 64 one-bit variants; a shuffle on the variants brings linked fingerprints
together. A bucket holds at most 65 fingerprints, the ball around its key, and
any two of them differ in at most two bits, so no bucket can grow hot. Copies
share a fingerprint and are folded before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import free_name, map_arrow, numbered, require, slices, text_views
from panelforge.llm.components import connected_components
from panelforge.session import land

SEED = 42
# The five odd constants of the public XXH64 definition (fixed values).
P1, P2, P3, P4, P5 = (
    np.uint64(v)
    for v in (
        11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261,
    )
)
# Lower-cases A-Z and maps the six white-space bytes to one.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[9:14] = 32


def _rotl(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxh64_ranges(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many byte ranges of one buffer, which must end in 8 spare bytes."""

    h = lengths.astype(np.uint64) + (np.uint64(seed) + P5)
    words = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    lanes = lengths >> 3
    for lane in range(3):
        at = np.flatnonzero((lanes > lane) & (lengths < 32))
        if not len(at):
            break
        k = _rotl(words[starts[at] + 8 * lane] * P2, 31) * P1
        h[at] = _rotl(h[at] ^ k, 27) * P1 + P4
    position = starts + (lanes << 3)
    at = np.flatnonzero((lengths & 4 > 0) & (lengths < 32))
    four = words[position[at]] & np.uint64(0xFFFFFFFF)
    h[at] = _rotl(h[at] ^ (four * P1), 23) * P2 + P3
    position = position + (lengths & 4)
    rest = lengths & 3
    for byte in range(3):
        at = np.flatnonzero((rest > byte) & (lengths < 32))
        h[at] = _rotl(h[at] ^ (data[position[at] + byte].astype(np.uint64) * P5), 11) * P1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    h = h ^ (h >> np.uint64(32))
    raw = memoryview(data)
    for i in np.flatnonzero(lengths >= 32):  # few shingles are this long
        h[i] = xxhash.xxh64_intdigest(raw[starts[i] : starts[i] + lengths[i]], seed)
    return h


def shingle_hashes(data: np.ndarray, bounds: np.ndarray, width: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of each text ``data[bounds[i]:bounds[i+1]]``, in order, and their number per text.

    A text of fewer than ``width`` words is one shingle; a text without words has none.
    """

    nothing = np.zeros(0, dtype=np.uint64), np.zeros(len(bounds) - 1, dtype=np.int64)
    low, high = int(bounds[0]), int(bounds[-1])
    if low == high:
        return nothing
    folded = FOLD[data[low:high]]
    solid = folded != 32
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = bounds[:-1] - low
    inner = inner[inner < high - low]
    begins[inner] = solid[inner]  # a word never crosses a text border
    word_starts = np.flatnonzero(begins)
    if not len(word_starts):
        return nothing
    # Pack the words with one space after each.
    chars = np.flatnonzero(solid)
    word_of = np.cumsum(begins)[chars] - 1
    packed = np.full(len(chars) + len(word_starts) + 8, 32, dtype=np.uint8)
    packed[np.arange(len(chars)) + word_of] = folded[chars]
    sizes = np.bincount(word_of, minlength=len(word_starts))
    place = np.cumsum(sizes + 1) - (sizes + 1)
    ends = place + sizes

    first_word = np.searchsorted(word_starts, bounds - low)
    words = np.diff(first_word)
    shingles = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    offset = np.cumsum(shingles) - shingles
    has = np.flatnonzero(shingles)
    owner = np.repeat(has, shingles[has])
    head = first_word[owner] + (np.arange(len(owner)) - offset[owner])
    tail = head + np.minimum(words[owner], width) - 1
    return xxh64_ranges(packed, place[head], ends[tail] - place[head], seed), shingles


def fingerprints(data: np.ndarray, bounds: np.ndarray, width: int = 3) -> np.ndarray:
    """SimHash of each text ``data[bounds[i]:bounds[i+1]]`` over its word shingles.

    A bit is set if more than half of the shingle hashes have it. A text of fewer
    than ``width`` words is one shingle; a text without words has fingerprint zero.
    """

    out = np.zeros(len(bounds) - 1, dtype=np.uint64)
    hashes, shingles = shingle_hashes(data, bounds, width)
    if not len(hashes):
        return out
    has = np.flatnonzero(shingles)
    offset = np.cumsum(shingles) - shingles

    # Count set bits in eight byte-wide lanes at a time, in runs of at most 255 hashes.
    runs = -(-shingles[has] // 255)
    run_of = np.repeat(np.arange(len(has)), runs)
    first_run = np.cumsum(runs) - runs
    cuts = offset[has][run_of] + 255 * (np.arange(len(run_of)) - first_run[run_of])
    ones = np.uint64(0x0101010101010101)
    result = np.zeros(len(has), dtype=np.uint64)
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & ones, cuts)
        counts = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), first_run, axis=0)
        more = 2 * counts > shingles[has][:, None]
        for byte in range(8):
            result |= more[:, byte].astype(np.uint64) << np.uint64(8 * byte + bit)
    out[has] = result
    return out


def with_fingerprints(
    df: DataFrame, id_column: str, text_column: str, width: int = 3, row: Column | None = None
) -> DataFrame:
    """``row``, ``id`` and ``fp`` of each input row; ``fp`` is the fingerprint as a signed 64-bit integer."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_views(batch.column(2))
            fps = [fingerprints(data, bounds[a : b + 1], width) for a, b in slices(bounds)]
            fp = np.concatenate(fps) if fps else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fp.view(np.int64))], names=["row", "id", "fp"]
            )

    kind = df.schema[id_column].dataType.simpleString()
    picked = df.select(
        (F.monotonically_increasing_id() if row is None else row).alias("row"), F.col(id_column).alias("id"),
        F.col(text_column).cast("string").alias("text"),
    )
    return map_arrow(picked, compute, f"row bigint, id {kind}, fp bigint")


def ball_links(fps: DataFrame) -> DataFrame:
    """Links (``a``, ``b``), ``a < b``, that join all of ``fps.fp`` within two bits of each other.

    ``fps`` holds distinct fingerprints. Within a bucket each fingerprint is linked to the
    next one, which connects what all pairs would connect. A pair that differs in two bits
    meets in two buckets, so pairs are made distinct, and each is verified.
    """

    variants = fps.select(
        "fp", F.explode(F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")).alias("v")
    )
    in_bucket = Window.partitionBy("v").orderBy("fp")
    return (
        variants.withColumn("a", F.lag("fp").over(in_bucket))
        .where("a is not null")
        .select("a", F.col("fp").alias("b"))
        .where("bit_count(a ^ b) <= 2")
        .distinct()
    )


def simhash_groups(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 3, row: Column | None = None
) -> DataFrame:
    """One row per input row: the id, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most two differing
    bits. Null and empty texts have fingerprint zero and are linked like any other; null
    ids are never a ``component_id`` unless a group has no other. Repeated rows each get
    a row. ``row`` and ``kept`` mark one row of each group, the named one. An empty table gives an empty result; other columns are ignored.
    """

    require(df, id_column, text_column)
    docs = land(with_fingerprints(df, id_column, text_column, width, row), "fingerprints")
    # The row that stands for a group: the smallest id, nulls last, and of repeated rows the first.
    least = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")).alias("least")
    distinct = land(docs.groupBy("fp").agg(least), "distinct-fingerprints")
    links = land(ball_links(distinct.select("fp")), "fingerprint-links")
    roots = connected_components(links)
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    rooted = land(rooted, "rooted-fingerprints")
    firsts = land(rooted.groupBy("root").agg(F.min("least").alias("first")), "component-firsts")
    named = land(rooted.join(firsts, "root").select("fp", "first"), "fingerprint-components")
    return docs.join(named, "fp").select(
        F.col("id").alias(id_column), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first.id").alias("component_id"), "row", (F.col("row") == F.col("first.row")).alias("kept"),
    )


def keep_one_per_component(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each component, the one named by ``component_id``, with all columns of ``df``.

    The numbered rows are stored once; both reads use those numbers.
    """

    row = free_name(df, "_row")
    stored = numbered(df, row)
    kept = simhash_groups(stored, id_column, text_column, row=F.col(row)).where("kept").select(F.col("row").alias(row))
    # The kept rows grow with the table, so both sides are dealt by row at every size.
    return stored.join(land(kept, "kept-rows").hint("shuffle_hash"), row, "left_semi").drop(row)
