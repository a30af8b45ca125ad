"""Prefix trie of rebuilt conversations, with count-min screening of prefix digests.

1. Turns are reduced to a 128-bit digest and a length, sorted by (conversation, turn) over
   range partitions, so a hot conversation spreads over tasks, and numbered.
2. A conversation gets the head of its base conversation. Its turns are sorted once more and
   hashed: the digest of a prefix is a polynomial over its turns, so the part of a
   conversation that continues in the next partition needs one carried number only.
3. A count-min sketch counts all prefix digests. It never counts too little, so an estimate
   of one proves that no other conversation has that prefix, nor any longer one of this
   conversation: those tails are final and leave the task as result rows.
4. Only prefixes whose parent may be shared are shuffled and grouped exactly. A full sketch
   proves less and shuffles more, and changes no result.
5. A node belongs to its smallest member, so each conversation owns one stretch of its path.
   Sums over subtrees are sums over the tree of those stretches, by pointer doubling, then
   running sums along each stretch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import map_arrow, require
from panelforge.session import land

#: Prefix digests are polynomials modulo a prime below 2^127, with a random point.
PRIME, POINT = (1 << 127) - 1, 0x5DEECE66D1B54A32D192ED03A3C59AC7
ROOT = bytes(16)
#: Hash functions of the sketch, the most cells of each as a power of two, and cells of one merged piece.
SKETCH_ROWS, MOST_CELL_BITS, PIECE = 3, 25, 1 << 16
#: Safety net only; the number of rounds grows with the logarithm of the tree's height.
MOST_ROUNDS = 64
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _ordered_turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv``, ``part``, ``at``, ``digest``, ``size`` of each turn, numbered from 0 in its partition's run of the conversation.

    Null turns come first; equal turns are ordered by digest.
    """

    said, spoken = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    light = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("turn"),
        F.unhex(F.md5(F.concat(F.length(said).cast("string"), F.lit(":"), said, spoken))).alias("digest"),
        F.length(spoken).alias("size"),
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            convs = batch.column("conv").to_numpy()
            heads = np.flatnonzero(np.append(True, convs[1:] != convs[:-1]))
            place = np.arange(len(convs)) - np.repeat(heads, np.diff(np.append(heads, len(convs))))
            if last == convs[0]:
                place[: heads[1] if len(heads) > 1 else len(convs)] += at
            last, at = convs[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), pa.array(np.full(len(convs), part)), pa.array(place), batch.column("digest"), batch.column("size")],
                names=["conv", "part", "at", "digest", "size"],
            )

    order = ["conv", "turn", "digest"]
    spread = light.repartitionByRange(*order).sortWithinPartitions(*order)
    return land(map_arrow(spread, number, "conv bigint, part bigint, at bigint, digest binary, size int"), "ordered-turns")


def _runs(rows: DataFrame) -> DataFrame:
    """Rows of each conversation per partition, and how many it has in earlier partitions."""

    runs = rows.groupBy("conv", "part").agg((F.max("at") + 1).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return land(runs.withColumn("skipped", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "conversation-runs")


def head_length(conv: Column, most: int) -> Column:
    """Turns that a conversation takes from its base: unsigned crc32 of its decimal id, modulo ``most`` + 1."""

    return F.crc32(conv.cast("string")) % (most + 1)


def rebuilt(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    block: int = 100, most: int = 5,
) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv``) and their rebuilt turns (``conv``, ``own``, ``pos``, ``digest``, ``size``), in that order.

    A rebuilt conversation c has the first h turns of conversation c - c % ``block``, then its
    own after its first h, with h from :func:`head_length`.
    """

    turns = _ordered_turns(df, conv, turn, role, text)
    runs = _runs(turns)
    convs = land(runs.groupBy("conv").agg(F.sum("n").alias("n")), "conversations")
    later = land(runs.where("skipped > 0").select("conv", "part", "skipped"), "continued-runs")  # one a partition at most
    placed = turns.join(later, ["conv", "part"], "left").withColumn("pos", F.col("at") + F.coalesce("skipped", F.lit(0)))
    h = head_length(F.col("conv"), most)
    own = placed.where(F.col("pos") >= h).select("conv", F.lit(1).alias("own"), "pos", "digest", "size")
    heads = placed.where((F.col("conv") % block == 0) & (F.col("pos") < most)).select(
        F.col("conv").alias("base"), "pos", "digest", "size"
    )
    members = convs.select("conv", (F.col("conv") - F.col("conv") % block).alias("base"), h.alias("h"))
    taken = members.join(heads, "base").where("pos < h").select("conv", F.lit(0).alias("own"), "pos", "digest", "size")
    return convs, taken.unionByName(own)


def _rolled(turns: DataFrame) -> DataFrame:
    """Sorted turns with the hash of their run up to them and before them, and whether the run goes on.

    ``at`` counts from 0 in the run, ``value`` and ``before`` are 16-byte numbers.
    """

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, at, value = TaskContext.get().partitionId(), None, 0, 0
        waiting = None  # the last row, until it is known whether its conversation goes on

        def pack(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.bool_())
            names = ["conv", "part", "at", "value", "before", "size", "more"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            out = []
            for conv, digest, size in zip(*(batch.column(n).to_pylist() for n in ("conv", "digest", "size"))):
                same = conv == last
                if waiting is not None:
                    out.append((*waiting, same))
                if not same:
                    last, at, value = conv, 0, 0
                before, value = value, (value * POINT + int.from_bytes(digest, "little")) % PRIME
                waiting = (conv, part, at, value.to_bytes(16, "little"), before.to_bytes(16, "little"), size)
                at += 1
            if out:
                yield pack(out)
        if waiting is not None:
            yield pack([(*waiting, False)])

    order = ["conv", "own", "pos"]
    schema = "conv bigint, part bigint, at bigint, value binary, before binary, size int, more boolean"
    return land(map_arrow(turns.repartitionByRange(*order).sortWithinPartitions(*order), roll, schema), "rolled-turns")


def _carried(rolled: DataFrame) -> tuple[dict[tuple[int, int], tuple[int, int]], set[tuple[int, int]]]:
    """For runs that continue a conversation: turns before and their hash; and the runs that are continued.

    Only conversations that lie on a partition border are collected, so at most two rows a partition.
    """

    ends = rolled.where("not more").groupBy("conv").agg(
        F.collect_list(F.struct("part", "at", "value")).alias("runs")  # one of each partition it lies in
    )
    carry, open_runs = {}, set()
    for row in ends.where(F.size("runs") > 1).collect():
        runs = sorted((r["part"], r["at"] + 1, int.from_bytes(r["value"], "little")) for r in row["runs"])
        count = value = 0
        for number, (part, n, own) in enumerate(runs):
            if number:
                carry[row["conv"], part] = (count, value)
            if number + 1 < len(runs):
                open_runs.add((row["conv"], part))
            count, value = count + n, (value * pow(POINT, n, PRIME) + own) % PRIME
    return carry, open_runs


def _prefixes(rolled: DataFrame) -> DataFrame:
    """One row per prefix of one turn or more: ``conv``, ``depth``, ``node``, ``parent``, ``size``, ``ends``."""

    carry, open_runs = _carried(rolled)

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, part, at, value, before, more = (batch.column(n) for n in ("conv", "part", "at", "value", "before", "more"))
            depth = at.to_numpy() + 1
            ends = ~np.asarray(more)
            touched = [k for k in set(zip(conv.to_pylist(), part.to_pylist())) if k in carry or k in open_runs]
            if touched:
                depth, node, parent = depth.copy(), value.to_pylist(), before.to_pylist()
                both = list(zip(conv.to_pylist(), part.to_pylist()))
                for i in [i for i, k in enumerate(both) if k in set(touched)]:
                    if both[i] in open_runs:
                        ends[i] = False
                    if both[i] in carry:
                        count, start = carry[both[i]]
                        up = pow(POINT, int(depth[i]) - 1, PRIME)
                        parent[i] = ((start * up + int.from_bytes(parent[i], "little")) % PRIME).to_bytes(16, "little")
                        node[i] = ((start * up * POINT + int.from_bytes(node[i], "little")) % PRIME).to_bytes(16, "little")
                        depth[i] += count
                value, before = pa.array(node, pa.binary()), pa.array(parent, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [conv, pa.array(depth), value, before, batch.column("size"), pa.array(ends)],
                names=["conv", "depth", "node", "parent", "size", "ends"],
            )

    return map_arrow(rolled, complete, "conv bigint, depth bigint, node binary, parent binary, size int, ends boolean")


def _cells(digests: pa.Array, bits: int) -> list[np.ndarray]:
    """Cell of each 16-byte digest for each hash function of the sketch."""

    halves = np.frombuffer(b"".join(digests.to_pylist()), dtype="<u8").reshape(-1, 2)
    found = []
    for turn in range(SKETCH_ROWS):
        h = (halves[:, 0] + np.uint64(2 * turn + 1) * halves[:, 1]) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        found.append((h >> np.uint64(64 - bits)).astype(np.int64))
    return found


def count_min(prefixes: DataFrame, bits: int) -> np.ndarray:
    """Count-min sketch of ``prefixes.node``: for each hash function ``2 ** bits`` cells that count to two.

    Each task fills a sketch of its own; the sketches are added piece by piece, and the
    driver gets the sum, at most ``SKETCH_ROWS * 2 ** MOST_CELL_BITS / 4`` bytes.
    """

    piece = min(PIECE, 1 << bits)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros((SKETCH_ROWS, 1 << bits), dtype=np.uint8)
        seen = False
        for batch in batches:
            if batch.num_rows:
                seen = True
                for row, cells in zip(sketch, _cells(batch.column(0), bits)):
                    cell, count = np.unique(cells, return_counts=True)
                    row[cell] = np.minimum(row[cell] + np.minimum(count, 2), 2)
        if seen:
            for number, cells in enumerate(sketch.reshape(-1, piece)):
                if cells.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number]), pa.array([_packed(cells)], pa.binary())], names=["piece", "cells"]
                    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total = None, None
        for batch in batches:
            for n, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n != number:
                    if number is not None:
                        yield one(number, total)
                    number, total = n, np.zeros(piece, dtype=np.uint8)
                total = np.minimum(total + _unpacked(cells), 2)
        if number is not None:
            yield one(number, total)

    def one(number: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([_packed(total)], pa.binary())], names=["piece", "cells"])

    schema = "piece bigint, cells binary"
    parts = map_arrow(prefixes.select("node"), fill, schema)
    merged = map_arrow(parts.repartition("piece").sortWithinPartitions("piece"), add, schema)
    out = np.zeros((SKETCH_ROWS * (1 << bits) // piece, -(-piece // 4)), dtype=np.uint8)
    for row in merged.collect():
        out[row["piece"]] = np.frombuffer(row["cells"], dtype=np.uint8)
    return out.reshape(SKETCH_ROWS, -1)


def _packed(cells: np.ndarray) -> bytes:
    four = cells.reshape(-1, 4)
    return (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    cells = np.frombuffer(data, dtype=np.uint8)
    return np.stack([cells >> s & 3 for s in (0, 2, 4, 6)], axis=1).ravel()


def _screened(prefixes: DataFrame, sketch: np.ndarray, bits: int) -> DataFrame:
    """``prefixes`` with ``alone``: the sketch proves that nobody else has the parent, so the node is final."""

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = np.ones(batch.num_rows, dtype=bool)
            for row, cell in zip(sketch, _cells(batch.column("parent"), bits)):
                shared &= (row[cell >> 2] >> (2 * (cell & 3)).astype(np.uint8) & 3) > 1
            shared |= np.asarray(batch.column("depth")) == 1  # the root is everybody's
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(~shared)], names=[*batch.schema.names, "alone"])

    schema = "conv bigint, depth bigint, node binary, parent binary, size int, ends boolean, alone boolean"
    return land(map_arrow(prefixes, screen, schema), "screened-prefixes")


def _member_hashes(ending: DataFrame) -> DataFrame:
    """``node`` and the SHA-256 of the ids ``conv``, ascending and joined by commas; ids stream by, none are gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for n, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n != node:
                    if node is not None:
                        done.append((node, digest.hexdigest()))
                    node, digest = n, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(b",%d" % conv)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])

    ordered = ending.select("node", "conv").repartition("node").sortWithinPartitions("node", "conv")
    return map_arrow(ordered, run, "node binary, ends_sha256 string")


def _subtree_totals(owners: DataFrame) -> DataFrame:
    """``conv``, ``leaves``, ``saved`` summed over each stretch and all stretches below it.

    ``owners`` has one row per stretch: ``conv``, its own sums, and ``up``, the conversation
    whose stretch it hangs on. Each round a stretch adds its sums to the one that ``up``
    names and takes over that one's ``up``, so distances double.
    """

    state = land(owners, "stretches")
    for _ in range(MOST_ROUNDS):
        if state.where("up is not null").isEmpty():
            return state.drop("up")
        gained = state.where("up is not null").groupBy(F.col("up").alias("conv")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        above = state.select(F.col("conv").alias("up"), F.col("up").alias("next"))
        state = land(
            state.join(gained, "conv", "left").join(above, "up", "left").select(
                "conv", F.col("next").alias("up"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "stretches",
        )
    raise RuntimeError(f"the tree did not settle in {MOST_ROUNDS} rounds")


def trie_nodes(convs: DataFrame, turns: DataFrame, cell_bits: int | None = None) -> DataFrame:
    """One row per trie node, from the results of :func:`rebuilt`.

    ``convs`` names each conversation once; those without turns end at the root.
    """

    prefixes = land(_prefixes(_rolled(turns)), "prefixes")
    if cell_bits is None:  # eight cells a prefix, four to a byte
        cell_bits = int(min(MOST_CELL_BITS, max(10, np.ceil(np.log2(max(prefixes.count(), 1) * 8)))))
    screened = _screened(prefixes, count_min(prefixes, cell_bits), cell_bits)

    tails = screened.where("alone").select(
        F.col("conv").alias("conv_id"), "depth", F.col("conv").alias("parent_conv_id"), F.lit(1).cast("bigint").alias("n_convs"),
        F.when(F.col("ends"), 0).otherwise(1).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(F.col("ends"), F.sha2(F.col("conv").cast("string"), 256)).otherwise(F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )

    open_nodes = screened.where("not alone").drop("alone")
    spoken = open_nodes.where("depth = 1").select("conv", F.lit(True).alias("spoken"))
    roots = convs.select("conv").join(spoken, "conv", "left").select(
        "conv", F.lit(0).cast("bigint").alias("depth"), F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"),
        F.lit(0).alias("size"), F.col("spoken").isNull().alias("ends"),
    )
    candidates = open_nodes.unionByName(roots)
    # The digest of the empty prefix may not be taken for that of a longer one, hence the depth.
    nodes = land(
        candidates.groupBy("node", "depth").agg(
            F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.min("parent").alias("parent"),
            F.min("size").alias("size"), F.sum(F.col("ends").cast("bigint")).alias("n_ends"),
        ),
        "trie-nodes",
    )
    shared = nodes.where("n_convs > 1")
    children = land(
        nodes.where("depth > 0").groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(
            F.count(F.lit(1)).alias("n_children"), F.sum((F.col("n_convs") == 1).cast("bigint")).alias("n_alone")
        ),
        "node-children",
    )
    above = shared.select(F.col("node").alias("parent"), (F.col("depth") + 1).alias("depth"), F.col("conv").alias("up"))
    # A node whose parent is not shared hangs on its own conversation.
    placed = land(nodes.join(above, ["parent", "depth"], "left").join(children, ["node", "depth"], "left"), "placed-nodes")

    inner = placed.where("n_convs > 1").select(
        "node", "depth", "conv", "parent", "up",
        (F.coalesce("n_alone", F.lit(0)) + (F.col("n_ends") == F.col("n_convs")).cast("bigint")).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
    )
    stretches = inner.groupBy("conv").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
        F.max(F.when(F.col("up") != F.col("conv"), F.col("up"))).alias("up"),
    )
    totals = _subtree_totals(stretches)
    hung = (
        inner.where("up <> conv").join(totals.select("conv", F.col("leaves").alias("l"), F.col("saved").alias("s")), "conv")
        .groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth"))
        .agg(F.sum("l").alias("hung_leaves"), F.sum("s").alias("hung_saved"))
    )
    below = Window.partitionBy("conv").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = land(
        inner.join(hung, ["node", "depth"], "left").select(
            "node", "depth",
            F.sum(F.col("leaves") + F.coalesce("hung_leaves", F.lit(0))).over(below).alias("n_leaves"),
            F.sum(F.col("saved") + F.coalesce("hung_saved", F.lit(0))).over(below).alias("saved_tokens"),
        ),
        "subtree-sums",
    )
    hashes = land(_member_hashes(candidates.where("ends").select("node", "conv")), "member-hashes")
    grouped = placed.join(sums, ["node", "depth"], "left").join(hashes, "node", "left").select(
        F.col("conv").alias("conv_id"), "depth",
        F.when(F.col("depth") > 0, F.coalesce("up", "conv")).alias("parent_conv_id"), "n_convs",
        F.when(F.col("n_convs") == 1, 1 - F.col("n_ends")).otherwise(F.coalesce("n_children", F.lit(0))).alias("n_children"),
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
    return grouped.unionByName(tails)


def conversation_trie(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    block: int = 100, most: int = 5, cell_bits: int | None = None,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations; see :func:`rebuilt`.

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Conversation ids are integers; rows without
    one belong to no conversation and are left out. Null turns come first; turns that are equal
    are ordered by a digest of role and text, so repeated rows are turns of their own. Null role
    or text counts as empty. An empty table has no node, not even a root. Other columns are ignored.
    """

    require(df, conv, turn, role, text)
    return trie_nodes(*rebuilt(df, conv, turn, role, text, block, most), cell_bits)
