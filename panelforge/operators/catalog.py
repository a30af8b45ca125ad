"""Table and column catalogs: building, selection, summaries, lookups, differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.numbers import GIB, pretty_bytes, strip, whole_or_zero
from panelforge.functions.text import blank_to_null, family_name

# Names listed per library, kind code of a real table, key constraint code.
SAMPLE_TABLES = 5
REAL_TABLE = "r"
PRIMARY_KEY = "p"


def canonical_libraries(namespaces: DataFrame, classes: DataFrame) -> DataFrame:
    """Libraries that hold at least one real table, with their table count."""

    real = classes.where(F.col("kind") == REAL_TABLE).groupBy("library").agg(
        F.count(F.lit(1)).alias("table_count")
    )
    # An inner join drops libraries without real tables, as the count filter asks.
    return namespaces.select("library").distinct().join(real, "library")


def library_tables(tables: DataFrame, library: str) -> DataFrame:
    """Base tables of one library in name order."""

    return tables.where(F.col("library") == library).select("table_name").orderBy("table_name")


def live_columns(attributes: DataFrame) -> DataFrame:
    return attributes.where((F.col("attnum") > 0) & ~F.col("dropped"))


def primary_keys(constraints: DataFrame, attributes: DataFrame) -> DataFrame:
    """Ordered primary-key column list per table.

    A key constraint names its columns by number, in key order; the source
    allows at most 32 of them, so the list per table is short.
    """

    positions = constraints.where(F.col("contype") == PRIMARY_KEY).select(
        "library", "table_name", F.posexplode("conkey").alias("ordinality", "attnum")
    )
    named = positions.join(
        attributes.select("library", "table_name", "attnum", "column_name"), ["library", "table_name", "attnum"]
    )
    ordered = F.array_sort(F.collect_list(F.struct("ordinality", "column_name")))
    return named.groupBy("library", "table_name").agg(
        F.array_join(F.transform(ordered, lambda k: k["column_name"]), ", ").alias("primary_key_columns")
    )


def table_catalog(
    classes: DataFrame, attributes: DataFrame, constraints: DataFrame, libraries: DataFrame
) -> DataFrame:
    """One row per real table of the given libraries."""

    counts = (
        live_columns(attributes).groupBy("library", "table_name").agg(F.count(F.lit(1)).alias("column_count"))
    )
    size = whole_or_zero(F.col("total_bytes"))
    return (
        classes.where(F.col("kind") == REAL_TABLE)
        .join(libraries.select("library").distinct(), "library", "left_semi")
        .join(counts, ["library", "table_name"], "left")
        .join(primary_keys(constraints, attributes), ["library", "table_name"], "left")
        .select(
            "library",
            "table_name",
            whole_or_zero(F.nullif(F.col("reltuples"), F.lit(-1))).alias("estimated_rows"),
            size.alias("total_table_bytes"),
            whole_or_zero(F.col("column_count")).alias("column_count"),
            "primary_key_columns",
            F.col("comment").alias("table_comment"),
            pretty_bytes(size).alias("size_pretty"),
        )
    )


def column_catalog(
    classes: DataFrame, attributes: DataFrame, defaults: DataFrame, libraries: DataFrame
) -> DataFrame:
    """One row per live column of a real table."""

    real = (
        classes.where(F.col("kind") == REAL_TABLE)
        .join(libraries.select("library").distinct(), "library", "left_semi")
        .select("library", "table_name")
    )
    return (
        live_columns(attributes)
        .join(real, ["library", "table_name"], "left_semi")
        .join(defaults.select("library", "table_name", "attnum", "column_default"),
              ["library", "table_name", "attnum"], "left")
        .select(
            "library",
            "table_name",
            whole_or_zero(F.col("attnum")).alias("ordinal_position"),
            "column_name",
            "data_type",
            F.coalesce(~F.col("not_null"), F.lit(False)).alias("nullable"),
            "column_default",
            F.col("comment").alias("column_comment"),
        )
    )


def library_summary(tables: DataFrame, order_column: str = "table_name") -> DataFrame:
    """Counts, sizes and sample names per library.

    The five sample names come from a top-k that is cut inside every input
    partition, so the names of a large library are never gathered. The example
    comment is the first non-blank one in ``order_column`` order.
    """

    known = tables.where(F.col("library").isNotNull())
    comment = blank_to_null(F.col("table_comment"))
    totals = known.groupBy("library").agg(
        F.count("table_name").alias("table_count"),
        F.coalesce(F.sum("estimated_rows"), F.lit(0)).alias("total_estimated_rows"),
        F.coalesce(F.sum("total_table_bytes"), F.lit(0)).alias("total_table_bytes"),
        F.coalesce(F.sum("column_count"), F.lit(0)).alias("total_column_count"),
        F.count(comment).alias("commented_table_count"),
        F.min_by(comment, F.when(comment.isNotNull(), F.col(order_column))).alias("_comment"),
    )
    by_name = Window.partitionBy("library").orderBy("table_name")
    names = (
        known.where(F.col("table_name").isNotNull())
        .select("library", "table_name", F.row_number().over(by_name).alias("rn"))
        .where(F.col("rn") <= SAMPLE_TABLES)
        .groupBy("library")
        .agg(F.array_join(F.array_sort(F.collect_list("table_name")), ", ").alias("_names"))
    )
    return totals.join(names, "library", "left").select(
        "library",
        "table_count",
        "total_estimated_rows",
        "total_table_bytes",
        pretty_bytes(F.col("total_table_bytes")).alias("size_pretty"),
        "total_column_count",
        "commented_table_count",
        F.coalesce("_names", F.lit("")).alias("sample_table_names"),
        F.coalesce("_comment", F.lit("")).alias("example_table_comment"),
    )


def by_size(summary: DataFrame) -> DataFrame:
    """Largest library first, then by name."""

    return summary.orderBy(F.col("total_table_bytes").desc(), "library")


def selection_problems(available: DataFrame, enabled: DataFrame, disabled: DataFrame) -> DataFrame:
    """Configured names without a live table: enabled ones are errors, disabled ones warnings."""

    keys = ["library", "table_name"]
    live = available.select(*keys)
    unknown = enabled.select(*keys).distinct().join(live, keys, "left_anti")
    stale = disabled.select(*keys).distinct().join(live, keys, "left_anti")
    return unknown.withColumn("problem", F.lit("unknown enabled table")).unionByName(
        stale.withColumn("problem", F.lit("stale disabled table"))
    )


def select_tables(
    available: DataFrame, libraries: DataFrame, enabled: DataFrame, disabled: DataFrame
) -> DataFrame:
    """Tables chosen by configuration.

    ``libraries``: library, library_position, enabled, download_all.
    ``enabled``: library, table_name, table_position. ``disabled``: library, table_name.
    A library that takes all tables lists them by name, the others in list
    order; disabled tables are always left out. An enabled table that is not
    live fails the job.
    """

    keys = ["library", "table_name"]
    active = libraries.where(F.coalesce(F.col("enabled"), F.lit(True)))
    take_all = F.coalesce(F.col("download_all"), F.lit(True))
    everything = available.select(*keys).join(
        active.where(take_all).select("library", "library_position"), "library"
    )
    listed = (
        enabled.join(active.where(~take_all).select("library", "library_position"), "library")
        .join(available.select(*keys, F.lit(True).alias("_live")).distinct(), keys, "left")
        .where(
            F.when(F.col("_live"), F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit("enabled table does not exist: "), F.col("table_name"))).cast("boolean")
            )
        )
    )
    chosen = everything.select(*keys, "library_position", F.lit(0).cast("bigint").alias("table_position")).unionByName(
        listed.select(*keys, "library_position", F.col("table_position").cast("bigint").alias("table_position"))
    )
    return chosen.join(disabled.select(*keys).distinct(), keys, "left_anti")


def selection_filter(selected: DataFrame, library: str | None = None, table: str | None = None) -> DataFrame:
    """Keep one library or table of a selection; nothing left is an error."""

    kept = selected
    if library is not None:
        kept = kept.where(F.col("library") == library)
    if table is not None:
        kept = kept.where(F.col("table_name") == table)
    if kept.isEmpty():
        raise ValueError(f"no tables match library={library!r}, table={table!r}")
    return kept


def distinct_names(names: DataFrame, name: str, position: str) -> DataFrame:
    """Trimmed, non-blank names at their first position."""

    trimmed = names.select(blank_to_null(F.col(name)).alias("name"), F.col(position).alias("position"))
    return trimmed.where(F.col("name").isNotNull()).groupBy("name").agg(F.min("position").alias("position"))


def merge_lookup(
    left: DataFrame, lookup: DataFrame, left_key: str, lookup_key: str, ordinal: str, columns: Sequence[str]
) -> DataFrame:
    """Left join of lookup columns on the trimmed key, first lookup row per key.

    Earlier copies of the columns are replaced. NULL keys match each other.
    """

    first = (
        lookup.groupBy(strip(F.col(lookup_key).cast("string")).alias("_key"))
        .agg(F.min_by(F.struct(*columns), F.col(ordinal)).alias("_found"))
    )
    base = left.drop(*columns).withColumn(left_key, strip(F.col(left_key).cast("string")))
    joined = base.join(first, base[left_key].eqNullSafe(first["_key"]), "left")
    return joined.select(*base.columns, *[F.col(f"_found.{c}").alias(c) for c in columns])


def merge_counts(merged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Matched and unmatched rows per merged column."""

    row = merged.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(f"_m{i}") for i, c in enumerate(columns)]
    )
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"_m{i}").alias("matched"),
                (F.col("_n") - F.col(f"_m{i}")).alias("unmatched"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return row.select(F.explode(pairs).alias("p")).select("p.*")


def family_rollup(tables: DataFrame) -> DataFrame:
    """Yearly tables rolled up to their family."""

    return (
        tables.groupBy(family_name(F.col("table_name")).alias("family"))
        .agg(
            F.count(F.lit(1)).alias("table_count"),
            F.min("table_name").alias("first_table"),
            F.max("table_name").alias("last_table"),
            F.sum("estimated_rows").alias("rows"),
            F.sum("total_table_bytes").alias("bytes"),
        )
        .withColumn("GiB", F.col("bytes") / F.lit(float(GIB)))
    )


def catalog_diff(live: DataFrame, local: DataFrame) -> DataFrame:
    """Tables found on one side only."""

    keys = ["library", "table_name"]
    live, local = live.select(*keys).distinct(), local.select(*keys).distinct()
    missing = live.join(local, keys, "left_anti").withColumn("side", F.lit("live_only"))
    extra = local.join(live, keys, "left_anti").withColumn("side", F.lit("local_only"))
    return missing.unionByName(extra)


def decode(rows: DataFrame, key: str, codes: DataFrame, code: str, label: str, name: str) -> DataFrame:
    """Attach a label column; rows without a known code keep NULL.

    The code table must be unique by ``code``. It is broadcast when its size
    allows (Spark checks), otherwise joined by shuffle.
    """

    lookup = codes.select(F.col(code).alias("_code"), F.col(label).alias(name))
    return rows.join(lookup, rows[key] == lookup["_code"], "left").drop("_code")


def best_link(links: DataFrame, person: str, other: str, min_score: float | None = None) -> DataFrame:
    """Highest-scored counterpart per person; ties go to the smallest id."""

    kept = links.where(F.col("score").isNotNull() & F.col(other).isNotNull())
    if min_score is not None:
        kept = kept.where(F.col("score") >= min_score)
    best = F.min_by(F.struct(other, "score", "match_style"), F.struct((-F.col("score")).alias("s"), other, "match_style"))
    return kept.groupBy(person).agg(best.alias("_b")).select(person, "_b.*")


def linked_records(people: DataFrame, links: DataFrame, targets: DataFrame, person: str, other: str) -> DataFrame:
    """Two hops: person to best link to the other vendor's record."""

    return people.join(links, person, "left").join(targets, other, "left")

