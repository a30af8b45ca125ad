"""Relationship edges checked against role spells.

An edge claims that two parties shared a third one between two years. It holds
when some spell of each side satisfies

    year(greatest(start_a, start_b)) <= overlap_end
    year(least(end_a, end_b))        >= overlap_start

``greatest(x, y) <= z`` is ``x <= z and y <= z`` (and likewise for ``least``),
so the pair condition splits into one condition per side, and no pair of spells
ever has to be formed. Each side becomes a lookup of one compact row per
(person, organisation): for every start year the latest end year, which
dominates all other spells that start in that year. The number of those entries
is bounded by the calendar, whatever the number of spells, so a hot person or
organisation cannot blow up a join. ``greatest`` skips NULLs: a spell without a
start passes the first test as long as the other side has a start.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.text import interpretation
from panelforge.session import land

SPELL_COLUMNS = ("person_id", "organisation_id", "start_date", "end_date", "src")


def role_spells(
    df: DataFrame, person: str, organisation: str, start: str, end: str, src: str, as_of: str
) -> DataFrame:
    """One source in the common spell shape; an open end runs to ``as_of``."""

    return df.select(
        F.col(person).alias("person_id"),
        F.col(organisation).alias("organisation_id"),
        F.col(start).cast("date").alias("start_date"),
        F.coalesce(F.col(end).cast("date"), F.lit(as_of).cast("date")).alias("end_date"),
        F.lit(src).alias("src"),
    )


def point_spells(df: DataFrame, person: str, organisation: str, on: str, src: str) -> DataFrame:
    """Point events in the spell shape: start and end are the event date."""

    return df.select(
        F.col(person).alias("person_id"),
        F.col(organisation).alias("organisation_id"),
        F.col(on).cast("date").alias("start_date"),
        F.col(on).cast("date").alias("end_date"),
        F.lit(src).alias("src"),
    )


def union_spells(sources: Iterable[DataFrame]) -> DataFrame:
    """Keep every row of every source (no de-duplication)."""

    return reduce(DataFrame.unionByName, [s.select(*SPELL_COLUMNS) for s in sources])


def spell_profile(spells: DataFrame) -> DataFrame:
    """One row per (person, organisation) with an array of year spans.

    ``spans`` holds, per start year, the latest end year; ``start_year`` is
    NULL for spells without a start. The set of year pairs is combined before
    the one shuffle, so copies of a spell never travel. It is then reduced to
    one entry per start year by two groupings that need no further shuffle,
    in time linear in the number of pairs.
    """

    pairs = (
        spells.where(F.col("person_id").isNotNull() & F.col("organisation_id").isNotNull())
        .groupBy("person_id", "organisation_id")
        .agg(
            F.collect_set(
                F.struct(F.year("start_date").alias("start_year"), F.year("end_date").alias("end_year"))
            ).alias("pairs")
        )
    )
    latest = (
        pairs.select("person_id", "organisation_id", F.inline("pairs"))
        .groupBy("person_id", "organisation_id", "start_year")
        .agg(F.max("end_year").alias("end_year"))
    )
    return latest.groupBy("person_id", "organisation_id").agg(
        F.array_sort(F.collect_list(F.struct("start_year", "end_year"))).alias("spans")
    )


def stored_profile(spells: DataFrame) -> DataFrame:
    """The profile, computed once and stored; the checks take it in the place of spells.

    A join that reads a stored table shuffles it by itself, directly below the join's
    sort, which is the form in which adaptive execution can split a hot key of the edges.
    """

    return land(spell_profile(spells), "spell-profile")


def _profile_of(spells: DataFrame) -> DataFrame:
    return spells if "spans" in spells.columns else stored_profile(spells)


def _side_flags(spans: Column, first_year: Column, last_year: Column) -> Column:
    """(any spell in range, any spell with a start in range) for one side."""

    def within(span: Column) -> Column:
        return F.coalesce(span["start_year"] <= last_year, F.lit(True)) & F.coalesce(
            span["end_year"] >= first_year, F.lit(False)
        )

    found = F.coalesce(F.exists(spans, within), F.lit(False))
    dated = F.coalesce(F.exists(spans, lambda s: within(s) & s["start_year"].isNotNull()), F.lit(False))
    return F.struct(found.alias("found"), dated.alias("dated"))


def _with_side(
    edges: DataFrame, profile: DataFrame, person: str, organisation: str, years: tuple[str, str], flag: str
) -> DataFrame:
    """Attach one side's flags. The profile key is unique, so rows never multiply."""

    side = profile.select(
        F.col("person_id").alias("_person"), F.col("organisation_id").alias("_organisation"), "spans"
    )
    joined = edges.join(
        side, (edges[person] == side["_person"]) & (edges[organisation] == side["_organisation"]), "left"
    )
    first_year, last_year = (F.col(name).cast("int") for name in years)
    return joined.withColumn(flag, _side_flags(F.col("spans"), first_year, last_year)).drop(
        "_person", "_organisation", "spans"
    )


def _matched(extra: Column | None = None) -> Column:
    held = (F.col("_a.found") & F.col("_b.dated")) | (F.col("_a.dated") & F.col("_b.found"))
    return held if extra is None else held & F.coalesce(extra, F.lit(False))


def check_person_edges(
    edges: DataFrame,
    spells: DataFrame,
    person_a: str,
    person_b: str,
    organisation: str,
    years: tuple[str, str],
) -> DataFrame:
    """Person-to-person edges through one shared organisation; adds ``matched``.

    The two persons must differ.
    """

    profile = _profile_of(spells)
    flagged = _with_side(edges, profile, person_a, organisation, years, "_a")
    flagged = _with_side(flagged, profile, person_b, organisation, years, "_b")
    return flagged.withColumn("matched", _matched(F.col(person_a) != F.col(person_b))).drop("_a", "_b")


def check_organisation_edges(
    edges: DataFrame,
    spells_a: DataFrame,
    spells_b: DataFrame,
    organisation_a: str,
    organisation_b: str,
    person: str,
    years: tuple[str, str],
    distinct_organisations: bool = False,
) -> DataFrame:
    """Organisation-to-organisation edges through one shared person; adds ``matched``.

    The two sides may come from different sources. ``distinct_organisations``
    additionally requires the organisations to differ.
    """

    profile_a = _profile_of(spells_a)
    profile_b = profile_a if spells_b is spells_a else _profile_of(spells_b)
    flagged = _with_side(edges, profile_a, person, organisation_a, years, "_a")
    flagged = _with_side(flagged, profile_b, person, organisation_b, years, "_b")
    extra = F.col(organisation_a) != F.col(organisation_b) if distinct_organisations else None
    return flagged.withColumn("matched", _matched(extra)).drop("_a", "_b")


def check_point_event_edges(
    edges: DataFrame,
    spells: DataFrame,
    events: DataFrame,
    organisation_a: str,
    organisation_b: str,
    person: str,
    years: tuple[str, str],
) -> DataFrame:
    """Edges whose second side is a dated event inside the edge's years.

    The spell side needs a start here (there is no second start to fall back
    on), which is the ``dated`` flag.
    """

    flagged = _with_side(edges, _profile_of(spells), person, organisation_a, years, "_a")
    event_years = land(
        events.groupBy("person_id", "organisation_id")
        .agg(F.collect_set(F.year("start_date")).alias("event_years"))
        .withColumnsRenamed({"person_id": "_person", "organisation_id": "_organisation"}),
        "event-years",
    )
    joined = flagged.join(
        event_years,
        (flagged[person] == event_years["_person"]) & (flagged[organisation_b] == event_years["_organisation"]),
        "left",
    )
    first_year, last_year = (F.col(name).cast("int") for name in years)
    held = F.coalesce(
        F.exists("event_years", lambda y: y.between(first_year, last_year)), F.lit(False)
    )
    return joined.withColumn("matched", F.col("_a.dated") & held).drop(
        "_a", "_person", "_organisation", "event_years"
    )


def check_exact_rows(
    rows: DataFrame, source: DataFrame, keys: Sequence[tuple[str, str]], nullable_keys: Sequence[tuple[str, str]]
) -> DataFrame:
    """Rows found in a source by equal keys; ``nullable_keys`` also match NULL to NULL.

    The source is reduced to its distinct keys first, so the join keeps one row
    per input row.
    """

    pairs = [*keys, *nullable_keys]
    known = source.select(*[F.col(right).alias(f"_k{i}") for i, (_, right) in enumerate(pairs)]).distinct()
    known = land(known.withColumn("_known", F.lit(True)), "known-rows")
    condition = [rows[left] == known[f"_k{i}"] for i, (left, _) in enumerate(keys)]
    condition += [
        rows[left].eqNullSafe(known[f"_k{i + len(keys)}"]) for i, (left, _) in enumerate(nullable_keys)
    ]
    joined = rows.join(known, reduce(Column.__and__, condition), "left")
    return joined.withColumn("matched", F.coalesce("_known", F.lit(False))).drop(
        "_known", *[f"_k{i}" for i in range(len(pairs))]
    )


def check_report(
    checked: DataFrame, table_name: str | Column, ordered_sample: bool = True
) -> DataFrame:
    """Checked and matched counts with their wording, per table name."""

    name = F.lit(table_name) if isinstance(table_name, str) else table_name
    counts = checked.select(name.alias("table_name"), "matched").groupBy("table_name").agg(
        F.count_if("matched").alias("matched_rows"), F.count(F.lit(1)).alias("checked_rows")
    )
    return counts.withColumn(
        "interpretation", interpretation(F.col("matched_rows"), F.col("checked_rows"), ordered_sample)
    )
