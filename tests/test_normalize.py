"""Normalization rules on literal values."""

from datetime import date
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelforge.functions.numbers import parse_number, pretty_bytes, quantize_half_even
from panelforge.operators import normalize as N
from panelforge.plans.contracts import RULES, SOURCE_COLUMNS, default_sort_columns, source_columns, target_type


def option(spark, schema, *rows):
    return N.normalize(spark.createDataFrame(list(rows), schema), RULES["opprcd"])


def problems(normalized):
    return [(r.column_name, r.problem) for r in N.violation_rows(normalized).collect()]


def test_null_category_and_counts(spark):
    n = option(spark, "cp_flag string, volume double, open_interest double", (None, 21.0, None), ("C", float("nan"), 3.0))
    rows = N.valid_rows(n).collect()
    assert [(r.cp_flag, r.volume, r.open_interest) for r in rows] == [(None, 21, None), ("C", None, 3)]
    assert N.valid_rows(n).schema["volume"].dataType.simpleString() == "bigint"


def test_sentinel_size_is_kept(spark):
    n = option(spark, "contract_size double", (-99.0,), (100.0,))
    assert [r.contract_size for r in N.valid_rows(n).collect()] == [-99, 100]


@pytest.mark.parametrize("value", [-99.0, 3.5, float("inf"), float(2**32)])
def test_bad_volume(spark, value):
    n = option(spark, "volume double", (value,))
    assert [c for c, _ in problems(n)] == ["volume"]
    with pytest.raises(Exception, match="volume must contain whole non-negative values"):
        N.strict_rows(n).collect()


def test_dates(spark):
    n = option(spark, "date string, exdate string", ("2024-01-02", None))
    assert N.valid_rows(n).collect()[0].date == date(2024, 1, 2)
    assert problems(option(spark, "date string", ("soon",))) == [("date", "must contain dates")]


def test_fixed_point_exact(spark):
    n = option(spark, "impl_volatility double, delta double, gamma double", (0.123456, -0.5, 0.001234))
    row = N.valid_rows(n).collect()[0]
    assert (row.impl_volatility, row.delta, row.gamma) == (Decimal("0.123456"), Decimal("-0.500000"), Decimal("0.001234"))


def test_wide_and_narrow_range(spark):
    wide = option(spark, "vega double, theta double", (2147.483648, -2147.483649))
    assert N.valid_rows(wide).collect()[0].vega == Decimal("2147.483648")
    assert [c for c, _ in problems(option(spark, "gamma double", (2147.483648,)))] == ["gamma"]
    assert problems(option(spark, "gamma double", (2147.483647,), (-2147.483648,))) == []
    # 2147.4836475 rounds to an even last digit outside, -2147.4836485 to one inside
    assert [c for c, _ in problems(option(spark, "gamma string", ("2147.4836475",)))] == ["gamma"]
    assert problems(option(spark, "gamma string", ("-2147.4836485",), ("2147.4836474",))) == []
    assert [c for c, _ in problems(option(spark, "delta double", (float("inf"),)))] == ["delta"]


def test_flags_and_domains(spark):
    assert [c for c, _ in problems(option(spark, "am_settlement int", (2,)))] == ["am_settlement"]
    assert [c for c, _ in problems(option(spark, "cp_flag string", ("X",)))] == ["cp_flag"]
    assert problems(option(spark, "ss_flag string, am_settlement int", ("E", 1), (None, None))) == []


def test_text_numbers_are_checked(spark):
    n = option(spark, "secid string", ("12",), ("1d",), (None,))
    assert problems(n) == [("secid", "must contain whole non-negative values no greater than 4294967295")]
    assert sorted(str(r.secid) for r in N.valid_rows(n).collect()) == ["12", "None"]


def test_valid_plus_violating_rows_is_everything(spark):
    rows = [(float(i) / 2, "C" if i % 3 else "Q") for i in range(40)]
    n = option(spark, "volume double, cp_flag string", *rows)
    bad = N.normalize(n.source.withColumn("id", F.monotonically_increasing_id()), RULES["opprcd"])
    violating = N.violation_rows(bad, ["id"]).select("id").distinct().count()
    assert N.valid_rows(n).count() + violating == len(rows)


def test_contracts():
    assert len(SOURCE_COLUMNS["opprcd"]) == 23 and len(SOURCE_COLUMNS["secprd"]) == 11
    assert not {"forward_price", "root", "suffix"} & set(SOURCE_COLUMNS["opprcd"])
    assert source_columns("secprd", "secprd2020")[0] == "secid"
    with pytest.raises(ValueError, match="no column contract"):
        source_columns("vsurfd", "vsurfd2020")
    assert target_type("opprcd", "optionid") == "decimal(20,0)" and target_type("opprcd", "vega") == "decimal(19,6)"


def test_source_year_goes_first(spark):
    df = spark.createDataFrame([(1.0, "2020-01-02")], "secid double, date string")
    with pytest.raises(ValueError, match="lacks contract columns"):
        N.normalize_family(df, "secprd", 2020)
    df = df.select("*", *[F.lit(None).cast("double").alias(c) for c in SOURCE_COLUMNS["secprd"] if c not in df.columns])
    assert N.valid_rows(N.normalize_family(df, "secprd", 2020)).columns[0] == "source_year"


def test_dates_are_whole(spark):
    texts = ["2024-01-02", "20240102", "2024-01-02 10:30:00", "2024-01-02T10:30:00Z", "2024-01-02 junk", "12024-01-01", "2024-02-30"]
    df = spark.createDataFrame([(t,) for t in texts], "date string")
    typed, check = N.date_rule(df, "date")
    rows = df.select(typed.cast("string").alias("d"), check.bad.alias("bad")).collect()
    assert [(r.d, r.bad) for r in rows] == [("2024-01-02", False)] * 4 + [(None, True)] * 3


def test_default_sort_columns():
    assert default_sort_columns(["x", "companyid", "directorid", "enddate", "startdate"]) == ["directorid", "startdate"]
    assert default_sort_columns(["x"]) == []


doubles = st.one_of(
    st.floats(allow_nan=False, allow_infinity=False, min_value=-1e12, max_value=1e12),
    st.integers(-10**9, 10**9).map(lambda i: (i * 10 + 5) / 1e7),
    st.integers(-10**6, 10**6).map(lambda i: i / 1e6),
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(doubles, min_size=60, max_size=60))
def test_quantize_equals_decimal_text(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.q for r in df.select(quantize_half_even(F.col("v"), "double").alias("q")).collect()]
    want = [Decimal(repr(v)).quantize(Decimal("0.000001"), ROUND_HALF_EVEN) for v in values]
    assert got == want


def test_float_text_is_not_widened(spark):
    df = spark.sql("SELECT CAST('0.1' AS FLOAT) AS f, CAST('123.4567' AS FLOAT) AS g")
    row = df.select(*[quantize_half_even(F.col(c), "float").alias(c) for c in ("f", "g")]).first()
    assert (row.f, row.g) == (Decimal("0.100000"), Decimal("123.456700"))


def test_number_grammar(spark):
    texts = ["1", " 1.5 ", "+.5", "5.", "1_000", "1e3", "1d", "", "0x1", "abc", "1__0", "-inf", "Infinity", "nan", "1e999"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.n for r in df.select(parse_number(F.col("t")).alias("n")).collect()]

    def python(t):
        try:
            return float(t)
        except ValueError:
            return None

    want = [python(t) for t in texts]
    assert [str(x) for x in got] == [str(x) for x in want]


def test_pretty_bytes(spark):
    values = [0, 1023, 1024, 1152, 1280, 1048576, 5 * 2**30 + 2**27, 2**40]
    df = spark.createDataFrame([(v,) for v in values], "b bigint")
    got = [r.p for r in df.select(pretty_bytes(F.col("b")).alias("p")).collect()]
    assert got == ["0 B", "1023 B", "1.00 KiB", "1.12 KiB", "1.25 KiB", "1.00 MiB", "5.12 GiB", "1024.00 GiB"]


def test_wide_methods_are_compiled_in_any_session(spark):
    """A session built elsewhere has Spark's own limit, under which the wide normalization runs interpreted."""

    from panelforge.suite.common import Tables

    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        spark.conf.set(name, "65535")
        Tables(spark, "unused")
        assert spark.conf.get(name) == "8000"
        spark.conf.set(name, "4000")  # a lower limit stays
        Tables(spark, "unused")
        assert spark.conf.get(name) == "4000"
    finally:
        spark.conf.set(name, before)
