"""Exact deduplication by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. All blocks are sorted and
equal blocks get one integer, the rank of their content. The integers of
adjacent blocks are then paired, the pairs are sorted and named in the same
way, and so on until one integer is left per text. Two texts share it exactly
when they are equal: names come from comparing contents, never from a hash.

Sorting is Spark's range partitioning on (digest, row) and a sort by content inside
each range, so the copies of a hot block spread over several tasks. The digest only
orders: should two different blocks with one digest ever meet in a task, the sort is
done again with the whole content as the range key. Each task ranks its own stretch; a prefix sum
over one summary row per task turns local ranks into global ones and joins a
block that continues across a task border.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.llm.common import free_name, map_arrow, numbered, require
from panelforge.session import land

#: Bytes in a block. Larger blocks need fewer rounds and larger samples for the range bounds.
BLOCK_BYTES = 1024


def rank_by_sort(
    df: DataFrame, keys: Sequence[str], ties: Sequence[str], label: str, lead: Column | None = None
) -> DataFrame:
    """Replace ``keys`` by ``name``, the dense rank of their values among all rows.

    One shuffle moves the rows. The driver receives Spark's sampled range bounds
    and one summary row per shuffle partition (two keys and a count), both bounded
    by the number of partitions and independent of the rows behind them. ``lead`` is
    a short value that equal keys share; ranges are then cut by it instead of by long
    keys, which keeps the samples small. Keys must not be null. The result is stored
    in the shared folder.
    """

    spark, has_lead = df.sparkSession, lead is not None
    payload = [c for c in df.columns if c not in keys]
    sorted_rows = df.withColumn("_lead", lead if has_lead else F.lit(0).cast("long"))
    range_keys = ["_lead", *([] if has_lead else keys), *ties]
    key_fields = [df.schema[k] for k in keys]
    out = T.StructType(
        [T.StructField(f.name, f.dataType) for f in df.schema if f.name in payload]
        + [T.StructField("_part", T.IntegerType()), T.StructField("_rank", T.LongType())]
        + [T.StructField("_clash", T.BooleanType())]
        + [T.StructField(f"_{side}_{f.name}", f.dataType) for side in ("first", "last") for f in key_fields]
    )

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen, first, last, last_lead, clash = 0, None, None, None, False
        schema = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k) for k in keys]
            change = np.zeros(batch.num_rows, dtype=bool)
            for column in columns:
                if batch.num_rows > 1:
                    change[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            leads = batch.column("_lead").to_numpy()
            start = [c[0].as_py() for c in columns]
            change[0] = last is None or start != last
            if has_lead:
                clash |= bool((change[1:] & (leads[1:] == leads[:-1])).any()) or bool(change[0] and leads[0] == last_lead)
                last_lead = leads[-1]
            ranks = seen + np.cumsum(change) - 1
            seen = int(ranks[-1]) + 1
            first = start if first is None else first
            last = [c[batch.num_rows - 1].as_py() for c in columns]
            arrays = [batch.column(c) for c in payload]
            if schema is None:
                schema = pa.schema(
                    [(c, batch.schema.field(c).type) for c in payload]
                    + [("_part", pa.int32()), ("_rank", pa.int64()), ("_clash", pa.bool_())]
                    + [(f"_{side}_{k}", batch.schema.field(k).type) for side in ("first", "last") for k in keys]
                )
            blank = [pa.nulls(batch.num_rows, schema.field(f"_{s}_{k}").type) for s in ("first", "last") for k in keys]
            parts = pa.array(np.full(batch.num_rows, part, np.int32))
            yield pa.RecordBatch.from_arrays(
                [*arrays, parts, pa.array(ranks, pa.int64()), pa.nulls(batch.num_rows, pa.bool_()), *blank], schema=schema
            )
        if schema is not None:  # one summary row: ``_rank`` is the count, the payload is null
            edge = [pa.array([v], schema.field(f"_first_{k}").type) for k, v in zip(keys, first)]
            edge += [pa.array([v], schema.field(f"_last_{k}").type) for k, v in zip(keys, last)]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, schema.field(c).type) for c in payload]
                + [pa.array([part], pa.int32()), pa.array([seen], pa.int64()), pa.array([clash]), *edge],
                schema=schema,
            )

    ranges = sorted_rows.repartitionByRange(*range_keys).sortWithinPartitions("_lead", *keys, *ties)
    ranked = land(map_arrow(ranges, rank, out), label)
    is_edge = F.col("_clash").isNotNull()
    edges = ranked.where(is_edge).select(
        "_part", "_rank", "_clash", F.struct(*[f"_first_{k}" for k in keys]).alias("a"),
        F.struct(*[f"_last_{k}" for k in keys]).alias("b"),
    )
    summary = sorted(edges.collect(), key=lambda r: r[0])
    if any(r["_clash"] for r in summary):
        return rank_by_sort(df, keys, ties, label)
    bases, base, previous = [], 0, None
    for part, count, _, start, end in summary:
        if previous is not None and tuple(start) == previous:
            base -= 1
        bases.append((part, base))
        base, previous = base + count, tuple(end)
    offsets = spark.createDataFrame(bases, "_part int, _base long")
    return (
        ranked.where(~is_edge)
        .join(F.broadcast(offsets), "_part")  # one row per shuffle partition
        .select(*payload, (F.col("_base") + F.col("_rank")).alias("name"))
    )


def name_texts(
    df: DataFrame, id_column: str, text_column: str, block_bytes: int = BLOCK_BYTES, row: Column | None = None
) -> DataFrame:
    """One row per input row: ``row``, ``id``, ``sha`` and the identity (``level``, ``name``).

    ``row`` is the given number of a row, or numbers the rows of the one scan made here. Texts are compared as UTF-8; null
    counts as empty, and an empty text is one empty block.
    """

    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    size = F.col("n")
    blocks = (
        df.select(
            (F.monotonically_increasing_id() if row is None else row).alias("row"), F.col(id_column).alias("id"),
            F.unhex(F.sha2(text, 256)).alias("sha"), text.cast("binary").alias("bytes"),
        )
        .withColumn("n", F.greatest(F.lit(1), F.ceil(F.length("bytes") / block_bytes)).cast("int"))
        .select(
            "row", "id", "sha", "n",
            F.posexplode(
                F.expr(f"transform(sequence(0, n - 1), i -> substring(bytes, i * {block_bytes} + 1, {block_bytes}))")
            ).alias("idx", "block"),
        )
        # The id and digest ride on the first block only.
        .select(
            "row", "idx", "n", F.when(F.col("idx") == 0, F.col("id")).alias("id"),
            F.when(F.col("idx") == 0, F.col("sha")).alias("sha"), "block",
        )
    )
    named = rank_by_sort(blocks, ["block"], ["row", "idx"], "block-names", F.xxhash64("block"))
    rounds = int(np.ceil(np.log2(named.agg(F.max("n")).first()[0] or 1)))
    done = []
    for level in range(rounds + 1):
        done.append(named.where(size == 1).select("row", "id", "sha", F.lit(level).alias("level"), "name"))
        if level == rounds:
            break
        even = F.col("idx") % 2 == 0
        pairs = (
            named.where(size > 1)
            .groupBy("row", F.shiftright("idx", 1).alias("idx"))
            .agg(
                F.max(F.shiftright(size + 1, 1)).alias("n"), F.max("id").alias("id"), F.max("sha").alias("sha"),
                F.max(F.when(even, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1).cast("long")).alias("right"),
            )
        )
        named = rank_by_sort(pairs, ["left", "right"], ["row", "idx"], f"pair-names-{level + 1}")
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def exact_groups(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES,
    row: Column | None = None,
) -> DataFrame:
    """Group equal texts; of each group the row with the largest id stays.

    Returns one row per input row: the id, ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256``. Null text equals empty text. Among rows with the same largest id
    (repeated rows) one is kept; null ids count as smallest. An empty table gives an
    empty result. Other columns of the input are ignored, whatever their names.
    """

    require(df, id_column, text_column)
    named = name_texts(df, id_column, text_column, block_bytes, row)
    # Stored, so that its size is known and a join with a hot group can be split.
    groups = land(
        named.groupBy("level", "name").agg(
            F.max(F.struct("id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size")
        ),
        "copy-groups",
    )
    return named.join(groups, ["level", "name"]).select(
        F.col("id").alias(id_column), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
        "row",
    )


def keep_one_of_each(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that :func:`exact_groups` keeps, with all columns of ``df``.

    The numbered rows are stored once; both reads use those numbers.
    """

    row = free_name(df, "_row")
    stored = numbered(df, row)
    kept = exact_groups(stored, id_column, text_column, row=F.col(row)).where("kept").select(F.col("row").alias(row))
    # The kept rows grow with the table, so both sides are dealt by row at every size.
    return stored.join(land(kept, "kept-rows").hint("shuffle_hash"), row, "left_semi").drop(row)
