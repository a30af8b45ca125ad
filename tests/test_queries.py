"""Every registered query against its SQL counterpart on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from panelforge.suite import all_queries, all_sql

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return repr(value) if isinstance(value, float) else str(value)


def multiset(rows):
    values = (tuple(plain(v) for v in r) for r in rows)
    return sorted(values, key=lambda r: tuple((v is None, v or "") for v in r))


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, DATA)
    columns = sorted(found.columns)
    rows = found.select(*[f"`{c}`" for c in columns]).collect()
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = [tuple(r[i] for i in order) for r in result.fetchall()]
    assert multiset(rows) == multiset(expected)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_sizes_of_large_keys(spark, tmp_path):
    rows = [(1_200_000, 50), (7, 1), (5_000_000, 3)]
    spark.createDataFrame(rows, "p_partkey bigint, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    got = {r.p_partkey: r.pretty for r in QUERIES["byte_sizes"](spark, str(tmp_path)).collect()}
    exact = {k: k**3 * s + 128 * s for k, s in rows}
    assert got == {1_200_000: f"{exact[1_200_000] / 2**30:.2f} GiB", 7: "471 B", 5_000_000: f"{exact[5_000_000] / 2**30:.2f} GiB"}
