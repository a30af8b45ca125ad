"""Snapshot comparison: full difference, sampled key comparison, drift, manifest."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.digests import row_digest, rows_fingerprint
from panelforge.session import land

# Fixed value: sampled rows per table in an audit.
SAMPLE_SIZE = 25


#: Ranges by leading digest bits, where the caller names none.
DIGEST_RANGES = 1024


def _ranges(ranges: Sequence[Column]) -> list[Column]:
    return list(ranges) or [F.pmod(F.conv(F.hex(F.substring("_digest", 1, 4)), 16, 10).cast("bigint"), F.lit(DIGEST_RANGES))]


def differing_ranges(local: DataFrame, live: DataFrame, ranges: Sequence[Column] = ()) -> DataFrame:
    """The ranges whose rows differ as multisets; stored, with columns ``range_0``, ``range_1`` ...

    The upper level of a digest tree: every row's digest is cut into 32-bit numbers, and these
    are summed per range, negated on one side. Sums merge before the shuffle, so equal
    snapshots shuffle one row per range and task. ``ranges`` are expressions over the rows, best
    the partition value and a range or class of the key, since changes then fall into few.
    """

    digest = row_digest(local.columns)
    by = _ranges(ranges)
    names = [f"range_{i}" for i in range(len(by))]

    def tagged(rows: DataFrame, sign: int) -> DataFrame:
        words = [F.conv(F.hex(F.substring("_digest", 1 + 4 * i, 4)), 16, 10).cast("bigint") * sign for i in range(4)]
        return rows.withColumn("_digest", digest).select(
            *[c.alias(n) for c, n in zip(by, names)], F.lit(sign).cast("bigint").alias("n"), *[w.alias(f"w{i}") for i, w in enumerate(words)]
        )

    sums = ["n", *[f"w{i}" for i in range(4)]]
    nets = tagged(local, 1).unionByName(tagged(live, -1)).groupBy(*names).agg(*[F.sum(c).alias(c) for c in sums])
    return land(nets.where(reduce(Column.__or__, [F.col(c) != 0 for c in sums])).select(*names), "differing-ranges")


def snapshot_diff(local: DataFrame, live: DataFrame, ranges: Sequence[Column] = ()) -> DataFrame:
    """Rows present more often on one side, with that side and the surplus copies.

    A digest tree of two levels: :func:`differing_ranges` names the ranges that differ, and
    only their rows are compared one by one, by 32-byte digests. The digests that
    differ are stored in the shared folder; their size is then known, so Spark
    broadcasts them when they are few and joins by shuffle when they are not.
    Full rows travel only for the answer. Copies are counted, not repeated.
    """

    columns = local.columns
    digest = row_digest(columns)
    changed = differing_ranges(local, live, ranges)
    by = _ranges(ranges)

    def in_changed(rows: DataFrame) -> DataFrame:
        same = reduce(Column.__and__, [c.eqNullSafe(F.col(n)) for c, n in zip(by, changed.columns)])
        return rows.withColumn("_digest", digest).join(changed, same, "left_semi").withColumnRenamed("_digest", "digest")

    here, there = in_changed(local), in_changed(live)
    tagged = here.select("digest", F.lit(1).alias("weight")).unionByName(there.select("digest", F.lit(-1).alias("weight")))
    nets = tagged.groupBy("digest").agg(F.sum("weight").alias("net"))
    surplus = land(nets.where(F.col("net") != 0), "snapshot-diff")

    def picked(rows: DataFrame, side: str, test: Column) -> DataFrame:
        wanted = surplus.where(test).select("digest", F.abs("net").alias("copies"))
        # One representative per digest; equal digests mean equal rows.
        found = (
            rows.select("digest", F.struct(*columns).alias("row"))
            .join(wanted, "digest")
            .groupBy("digest", "copies")
            .agg(F.any_value("row").alias("row"))
        )
        return found.select(F.lit(side).alias("side"), "copies", "row.*")

    return picked(here, "local_only", F.col("net") > 0).unionByName(picked(there, "live_only", F.col("net") < 0))


def sample_positions(df: DataFrame, table: str, keys: Sequence[str], size: int = SAMPLE_SIZE) -> DataFrame:
    """The rows with the ``size`` smallest key hashes of each table.

    The same rows come back on every run and from every engine with MD5. Only
    keys and hashes are sorted, and cut to ``size`` per input partition before
    the shuffle. The sampled keys, at most ``size`` per table, are stored, and
    the full rows are picked by them. Keys must identify a row and hold no NULL.
    """

    key_hash = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    first = Window.partitionBy(table).orderBy("key_hash", *keys)
    chosen = (
        df.select(table, *keys, key_hash.alias("key_hash"))
        .withColumn("position", F.row_number().over(first))
        .where(F.col("position") <= size)
    )
    return df.join(land(chosen, "sampled-keys"), [table, *keys])


def compare_by_key(
    sample: DataFrame, other: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Look sampled rows up in another snapshot and compare column by column.

    Adds ``outcome`` (``match``, ``changed``, ``absent``) and the changed column
    names. The keys must be unique in ``other``. The sampled keys are stored, so
    that a small sample (see :func:`sample_positions`) thins out ``other`` during
    its scan and the other snapshot is not shuffled.
    """

    wanted = land(sample.select(*keys).distinct(), "compared-keys")
    right = other.join(wanted, list(keys), "left_semi").select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_c_{c}") for c in columns],
        F.lit(True).alias("_known"),
    )
    condition = reduce(Column.__and__, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    joined = sample.join(right, condition, "left")
    changed = F.array_compact(
        F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"_c_{c}")), F.lit(c)) for c in columns])
    )
    return joined.select(
        *sample.columns,
        F.when(F.col("_known").isNull(), "absent")
        .when(F.size(changed) == 0, "match")
        .otherwise("changed")
        .alias("outcome"),
        F.when(F.col("_known").isNull(), F.lit("")).otherwise(F.array_join(changed, ",")).alias("changed_columns"),
    )


def drift_report(local_counts: DataFrame, live_counts: DataFrame, compared: DataFrame) -> DataFrame:
    """Counts, sample results and status per table.

    ``compared`` carries ``table_name`` and ``outcome`` per sampled row.
    """

    samples = compared.groupBy("table_name").agg(
        F.count_if(F.col("outcome") == "match").alias("sample_matches"),
        F.count_if(F.col("outcome") != "match").alias("sample_issues"),
    )
    joined = (
        local_counts.select("table_name", F.col("row_count").alias("local_rows"))
        .join(live_counts.select("table_name", F.col("row_count").alias("live_rows")), "table_name", "left")
        .join(samples, "table_name", "left")
        .select(
            "table_name",
            "local_rows",
            F.coalesce("live_rows", F.lit(0)).alias("live_rows"),
            F.coalesce("sample_matches", F.lit(0)).alias("sample_matches"),
            F.coalesce("sample_issues", F.lit(0)).alias("sample_issues"),
        )
        .withColumn("difference", F.col("live_rows") - F.col("local_rows"))
    )
    return joined.withColumn(
        "status",
        F.when((F.col("sample_issues") > 0) | (F.col("difference") < 0), "DRIFT_REVIEW")
        .when(F.col("difference") > 0, "GOOD_OLDER_SNAPSHOT")
        .otherwise("GOOD_MATCH"),
    )


def schema_fingerprint(df: DataFrame) -> str:
    """Digest of names, types and nullability; computed from metadata only."""

    text = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def manifest(
    df: DataFrame, table_name: str, keys: Sequence[str], written_at: str, size: int = SAMPLE_SIZE
) -> DataFrame:
    """Count, time, fingerprints of schema and rows, and ``size`` sampled row hashes of one table.

    ``rows_fingerprint`` is that of :func:`panelforge.functions.digests.rows_fingerprint`, which a
    load records too, so a manifest tells whether a target still holds what was written.
    """

    sampled = sample_positions(df.withColumn("_table", F.lit(table_name)), "_table", keys, size)
    hashes = sampled.select("position", F.lower(F.hex(row_digest(df.columns))).alias("h"))
    in_order = F.array_sort(F.collect_list(F.struct("position", "h")))  # at most ``size`` entries
    return hashes.agg(
        F.array_join(F.transform(in_order, lambda p: p["h"]), ",").alias("sample_row_hashes")
    ).select(
        F.lit(table_name).alias("table_name"),
        df.agg(F.count(F.lit(1))).scalar().alias("row_count"),
        F.lit(written_at).cast("timestamp_ntz").alias("written_at"),
        F.lit(schema_fingerprint(df)).alias("schema_fingerprint"),
        df.agg(rows_fingerprint(df.columns)).scalar().alias("rows_fingerprint"),
        "sample_row_hashes",
    )
