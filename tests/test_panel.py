"""Panel analytics against direct computation."""

import math
import random
from datetime import date, timedelta
from statistics import stdev

from pyspark.sql import functions as F

from panelforge.operators import panel as P


def test_link_join_open_ends_and_gaps(spark):
    panel = spark.createDataFrame(
        [(1, date(2000, 5, 1)), (1, date(2001, 5, 1)), (2, date(2000, 1, 1)), (3, date(2000, 1, 1))], "secid bigint, date date"
    )
    links = spark.createDataFrame(
        [(1, date(1990, 1, 1), date(2000, 12, 31), 11, 1.0), (1, date(2001, 1, 1), date(9000, 1, 1), 12, 2.0),
         (2, date(2000, 1, 2), date(2000, 12, 31), 21, 1.0), (3, None, date(2000, 12, 31), 31, 1.0)],
        "secid bigint, sdate date, edate date, permno bigint, score double",
    )
    got = sorted((r.secid, r.date.year, r.permno) for r in P.link_join(panel, links).collect())
    assert [(a, b, c) for a, b, c in got] == [(1, 2000, 11), (1, 2001, 12), (2, 2000, None), (3, 2000, None)]
    only = P.link_join(panel, links, score=1, how="inner").collect()
    assert [r.permno for r in only] == [11]


def test_lag_uses_the_panel_calendar(spark):
    days = [date(2000, 11, 27), date(2000, 11, 28), date(2000, 11, 30)]
    rows = [("a", days[0], 1), ("a", days[1], 2), ("a", days[2], 3), ("b", days[0], 7), ("b", days[2], 9)]
    out = P.lag_trading_day(spark.createDataFrame(rows, "k string, date date, oi int"), ["k"], "oi").collect()
    got = {(r.k, r.date): (r.lagged_oi, r.regime) for r in out}
    assert got[("a", days[2])] == (2, "lagged_by_source") and got[("a", days[1])] == (1, "same_day")
    assert got[("b", days[2])] == (None, "lagged_by_source")  # no row on the 28th: no older value


def test_volatility_equals_direct_windows(spark):
    rng = random.Random(3)
    days = sorted(rng.sample(range(900), 300))
    rows = [("x", date(2000, 1, 1) + timedelta(d), None if i == 0 else rng.uniform(-0.05, 0.05)) for i, d in enumerate(days)]
    windows = (10, 30, 365)
    out = P.historical_volatility(
        spark.createDataFrame(rows, "secid string, date date, return double"), windows, annualize=252
    ).collect()
    assert len(out) == len(rows) * len(windows)
    for r in out:
        inside = [math.log1p(x) for _, d, x in rows if x is not None and 0 <= (r.date - d).days < r.window_days]
        assert r.observations == len(inside)
        if len(inside) < 2:
            assert r.volatility is None
        else:
            assert math.isclose(r.volatility, stdev(inside) * math.sqrt(252), rel_tol=1e-7, abs_tol=1e-9)


def test_volume_totals_rows(spark):
    rows = [(1, "C", 5, 1), (1, "C", None, 2), (1, None, 3, 4), (2, "P", None, None)]
    out = P.volume_totals(
        spark.createDataFrame(rows, "secid int, cp_flag string, volume int, open_interest int").withColumn("date", F.lit(None).cast("date"))
    ).collect()
    got = sorted((r.secid, str(r.cp_flag), r.is_total, r.volume, r.open_interest, r.contracts) for r in out)
    assert got == [(1, "C", False, 5, 3, 2), (1, "None", False, 3, 4, 1), (1, "None", True, 8, 7, 3),
                   (2, "None", True, None, None, 1), (2, "P", False, None, None, 1)]


def test_volatility_ignores_nan_and_survives_an_outlier(spark):
    rng = random.Random(5)
    first = date(2000, 1, 1)
    rows = [("x", first + timedelta(i), rng.uniform(-1e-5, 1e-5)) for i in range(1200)]
    rows[3] = ("x", rows[3][1], float("nan"))
    rows[7] = ("x", rows[7][1], 1e5)
    rows[9] = ("x", rows[9][1], float("inf"))
    out = P.historical_volatility(spark.createDataFrame(rows, "secid string, date date, return double"), (5, 30)).collect()
    for r in out:
        inside = [math.log1p(x) for _, d, x in rows if math.isfinite(x) and 0 <= (r.date - d).days < r.window_days]
        assert r.observations == len(inside)
        if len(inside) >= 2:
            assert math.isclose(r.volatility, stdev(inside), rel_tol=1e-7)


def test_any_label_keeps_its_row(spark):
    rows = [(1, "C", 5, 1), (1, "X", 2, 2), (1, "X", None, None)]
    out = P.volume_totals(
        spark.createDataFrame(rows, "secid int, cp_flag string, volume int, open_interest int").withColumn("date", F.lit(None).cast("date"))
    ).collect()
    assert sorted((str(r.cp_flag), r.volume, r.contracts) for r in out) == [("C", 5, 1), ("None", 7, 3), ("X", 2, 2)]


def test_stated_years_save_the_scan(spark):
    panel = spark.createDataFrame([(1, date(2000, 5, 1)), (1, date(2001, 5, 1))], "secid bigint, date date")
    links = spark.createDataFrame([(1, date(1990, 1, 1), date(9000, 1, 1), 12, 2.0)], "secid bigint, sdate date, edate date, permno bigint, score double")
    assert [r.permno for r in P.link_join(panel, links, years=(2000, 2001)).collect()] == [12, 12]


def test_volatility_is_exact_beside_outliers(spark):
    """Returns of 1e-4 next to one of a million, two keys side by side, gaps in days, rows without a value."""

    rng = random.Random(8)
    rows = []
    for key in ("a", None, "b"):
        day = date(1990, 1, 1)
        for i in range(1500):
            day += timedelta(days=rng.choice([1, 1, 1, 2, 3, 200 if i % 400 == 0 else 1]))
            value = 1e6 if i in (300, 900) else None if i % 37 == 0 else float("nan") if i % 41 == 0 else rng.gauss(0, 1e-4)
            rows.append((key, day, value))
    table = spark.createDataFrame(rows, "secid string, date date, return double")
    got = {(r.secid, r.date, r.window_days): r for r in P.historical_volatility(table).collect()}
    assert len(got) == len(rows) * len(P.VOLATILITY_WINDOWS)
    for key, day, _ in rng.sample(rows, 150):
        for w in P.VOLATILITY_WINDOWS:
            inside = [math.log1p(x) for k, d, x in rows if k == key and x is not None and x == x and 0 <= (day - d).days < w]
            r = got[key, day, w]
            assert r.observations == len(inside)
            if len(inside) < 2:
                assert r.volatility is None
            else:
                assert math.isclose(r.volatility, stdev(inside), rel_tol=1e-9)
