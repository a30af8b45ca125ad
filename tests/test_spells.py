"""Edge checks against a brute-force pair search."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from panelforge.functions.text import interpretation
from panelforge.operators import spells as S

AS_OF = "2024-06-30"
SPELLS = "person bigint, organisation bigint, s date, e date"


def random_spells(rng, n, people=5, organisations=4):
    rows = []
    for _ in range(n):
        start = date(rng.randint(1990, 2010), rng.randint(1, 12), 1) if rng.random() > 0.2 else None
        end = date(rng.randint(1990, 2015), 1, 1) if rng.random() > 0.3 else None
        rows.append((rng.randrange(people), rng.randrange(organisations), start, end))
    return rows


def holds(a, b, first, last):
    starts = [x for x in (a[2], b[2]) if x is not None]
    ends = [x or date(2024, 6, 30) for x in (a[3], b[3])]
    return bool(starts) and max(starts).year <= last and min(ends).year >= first


def spells(spark, rows):
    return S.role_spells(spark.createDataFrame(rows, SPELLS), "person", "organisation", "s", "e", "emp", AS_OF)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_person_edges_equal_pair_search(spark, seed):
    rng = random.Random(seed)
    rows = random_spells(rng, 60)
    edges = [(rng.randrange(5), rng.randrange(5), rng.randrange(4), y := rng.randint(1985, 2020), y + rng.randint(-1, 5)) for _ in range(200)]
    df = spark.createDataFrame(edges, "a bigint, b bigint, o bigint, y0 int, y1 int")
    got = sorted(tuple(r) for r in S.check_person_edges(df, spells(spark, rows), "a", "b", "o", ("y0", "y1")).collect())
    want = sorted(
        (a, b, o, y0, y1, a != b and any(
            holds(x, y, y0, y1) for x in rows if x[:2] == (a, o) for y in rows if y[:2] == (b, o)))
        for a, b, o, y0, y1 in edges
    )
    assert got == want


@pytest.mark.parametrize("distinct", [True, False])
def test_organisation_edges_equal_pair_search(spark, distinct):
    rng = random.Random(7)
    left, right = random_spells(rng, 50), random_spells(rng, 50)
    edges = [(rng.randrange(4), rng.randrange(4), rng.randrange(5), y := rng.randint(1985, 2020), y + rng.randint(0, 5)) for _ in range(200)]
    df = spark.createDataFrame(edges, "a bigint, b bigint, p bigint, y0 int, y1 int")
    checked = S.check_organisation_edges(
        df, spells(spark, left), spells(spark, right), "a", "b", "p", ("y0", "y1"), distinct_organisations=distinct
    )
    got = sorted(tuple(r) for r in checked.collect())
    want = sorted(
        (a, b, p, y0, y1, (a != b or not distinct) and any(
            holds(x, y, y0, y1) for x in left if x[:2] == (p, a) for y in right if y[:2] == (p, b)))
        for a, b, p, y0, y1 in edges
    )
    assert got == want


def test_hot_key_profile_is_bounded_by_years(spark):
    hot = spark.range(20000).select(
        F.lit(1).cast("bigint").alias("person_id"), F.lit(1).cast("bigint").alias("organisation_id"),
        F.expr("date_add(date'1990-01-01', cast(id % 7300 as int))").alias("start_date"),
        F.expr("date_add(date'1991-01-01', cast(id % 7300 as int))").alias("end_date"), F.lit("x").alias("src"),
    )
    row = S.spell_profile(hot).collect()
    assert len(row) == 1 and len(row[0].spans) == 20


def test_exact_rows_null_safe_on_end_only(spark):
    source = spark.createDataFrame([(1, "ceo", None), (2, None, None)], "id int, role string, e date")
    rows = spark.createDataFrame([(1, "ceo", None), (1, "ceo", date(2020, 1, 1)), (2, None, None)], "id int, role string, e date")
    out = S.check_exact_rows(rows, source, [("id", "id"), ("role", "role")], [("e", "e")]).collect()
    assert sorted((r.id, str(r.e), r.matched) for r in out) == [(1, "2020-01-01", False), (1, "None", True), (2, "None", False)]


def test_edges_without_spells_stay(spark):
    df = spark.createDataFrame([(1, 2, None, 2000, 2001)], "a bigint, b bigint, o bigint, y0 int, y1 int")
    out = S.check_person_edges(df, spells(spark, [(1, 1, None, None)]), "a", "b", "o", ("y0", "y1")).collect()
    assert [r.matched for r in out] == [False]


@pytest.mark.parametrize(
    "matched,checked,ordered,start",
    [(2, 2, True, "All 2 checked rows"), (1, 2, False, "Only 1 of 2 checked rows"), (0, 2, True, "None of the 2"),
     (0, 0, True, "No rows were checked.")],
)
def test_interpretation(spark, matched, checked, ordered, start):
    df = spark.range(1).select(interpretation(F.lit(matched), F.lit(checked), ordered).alias("t"))
    text = df.first().t
    assert text.startswith(start) and text.endswith("different rows.") == (not ordered)


def test_hot_edges_are_split(spark):
    """With one (person, organisation) in most edges, the join's large partition is cut into several tasks."""

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.col("id") % 10 != 0
        edges = spark.range(0, 60_000, 1, 16).select(
            F.when(hot, 1).otherwise(F.col("id")).alias("a"), F.lit(2).alias("b"),
            F.when(hot, 7).otherwise(F.col("id") % 50).alias("o"), F.lit(2000).alias("y1"), F.lit(2001).alias("y2"),
        )
        spells = spark.range(2000).select(
            F.col("id").alias("person_id"), (F.col("id") % 50).alias("organisation_id"),
            F.lit("1999-01-01").cast("date").alias("start_date"), F.lit("2005-01-01").cast("date").alias("end_date"), F.lit("s").alias("src"),
        )
        checked = S.check_person_edges(edges, spells, "a", "b", "o", ("y1", "y2"))
        checked.collect()
        assert "skew=true" in checked._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_profile_takes_one_shuffle_and_keeps_the_latest_end(spark):
    rows = random_spells(random.Random(5), 400)
    source = S.role_spells(spark.createDataFrame(rows, SPELLS), "person", "organisation", "s", "e", "x", AS_OF)
    profile = S.spell_profile(source)
    assert profile._jdf.queryExecution().sparkPlan().toString().count("filter(") == 0
    assert profile._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    want = {}
    for person, organisation, start, end in rows:
        key, year = (person, organisation), start.year if start else None
        spans = want.setdefault(key, {})
        spans[year] = max(spans.get(year, 0), (end or date(2024, 6, 30)).year)
    got = {(r.person_id, r.organisation_id): {s.start_year: s.end_year for s in r.spans} for r in profile.collect()}
    assert got == want


def test_associations_store_each_profile_once(spark, tmp_path, monkeypatch):
    """The jobs are a side of both checks; their profile is made once, that of the activities once."""

    from panelforge.operators import spells
    from panelforge.suite import spell_queries as Q
    from panelforge.suite.common import Tables

    spark.range(1, 9).selectExpr(
        "id AS o_orderkey", "id % 3 AS o_custkey", "timestamp '1997-01-01 00:00:00' AS o_orderdate", "'1-URGENT' AS o_orderpriority"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1, 9).selectExpr(
        "id AS l_orderkey", "id % 4 AS l_partkey", "id % 2 AS l_suppkey", "int(id % 7 + 1) AS l_linenumber",
        "if(id % 2 = 0, 'A', 'N') AS l_returnflag", "timestamp '1997-03-01 00:00:00' AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1, 9).selectExpr(
        "id AS event_id", "id % 3 AS user_id", "if(id % 2 = 0, 'click', 'view') AS event_type", "timestamp '2024-01-01 00:00:00' AS ts"
    ).write.parquet(f"{tmp_path}/events.parquet")
    made, make = [], spells.spell_profile
    monkeypatch.setattr(spells, "spell_profile", lambda df: made.append(df) or make(df))
    rows = Q.association_report(Tables(spark, str(tmp_path))).collect()
    assert len(made) == 2
    assert {r.table_name: r.checked_rows for r in rows} == {"listed_assoc": 4, "unlisted_assoc": 4, "nfp_assoc": 8}
