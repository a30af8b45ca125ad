"""Declared schemas."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from panelforge.operators import conform as C


def columns(spark, *rows):
    return spark.createDataFrame(
        [("lib", "tab", i, n, d, nullable) for i, (n, d, nullable) in enumerate(rows, 1)],
        "library string, table_name string, ordinal_position int, column_name string, data_type string, nullable boolean",
    )


def test_schema_from_catalog(spark):
    schema = C.table_schema(
        columns(spark, ("name", "text", True), ("x", "double precision", True), ("d", "date", False), ("n", "numeric(12,2)", True)),
        "lib", "tab",
    )
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == [
        ("name", "string", True), ("x", "double", True), ("d", "date", False), ("n", "decimal(12,2)", True)
    ]


def test_arrays_and_odd_types(spark):
    schema = C.table_schema(
        columns(spark, ("a", "integer[]", True), ("b", "text[][]", True), ("c", "time without time zone", True),
                ("e", "numeric(50,2)", True), ("f", "Character Varying(30)", True)), "lib", "tab",
    )
    assert [f.dataType.simpleString() for f in schema] == ["array<int>", "array<array<string>>", "bigint", "string", "string"]


def test_unsupported_type_fails(spark):
    with pytest.raises(Exception, match="unsupported column type: point"):
        C.table_schemas(columns(spark, ("p", "point", True))).collect()


def test_null_only_column_keeps_type(spark):
    df = spark.createDataFrame([(None,), (None,)], "s string")
    out = C.conform(df, T.StructType.fromDDL("s bigint"))
    assert out.schema["s"].dataType == T.LongType() and out.count() == 2


def test_sentinel_dates_and_decimals(spark):
    df = spark.createDataFrame([("9000-01-01", "1.50"), ("20051201", None)], "d string, n string")
    out = C.conform(df, T.StructType.fromDDL("n decimal(12,2), d date"))
    assert out.columns == ["n", "d"]
    assert [tuple(r) for r in out.collect()] == [(Decimal("1.50"), date(9000, 1, 1)), (None, date(2005, 12, 1))]
    assert [r.d for r in C.dates_to_text(out).collect()] == ["9000-01-01", "2005-12-01"]


def test_bad_value_fails_with_context(spark):
    df = spark.createDataFrame([("2005",)], "d string")
    schema = T.StructType.fromDDL("d date")
    with pytest.raises(Exception, match="column d does not fit date: 2005"):
        C.conform(df, schema).collect()
    row = C.conform_problems(df, schema).first()
    assert (row.column_name, row.bad_values, row.sample_values) == ("d", 1, "2005")


def test_cut_and_rounded_values_fail(spark):
    schema = T.StructType.fromDDL("a int, b bigint, c decimal(12,2)")
    good = spark.createDataFrame([(3.0, 300.0, "1.23"), (None, None, None)], "a double, b double, c string")
    assert [tuple(map(str, r)) for r in C.conform(good, schema).collect()] == [("3", "300", "1.23"), ("None",) * 3]
    bad = spark.createDataFrame([(3.7, 300.5, "1.239")], "a double, b double, c string")
    found = {r.column_name: r.sample_values for r in C.conform_problems(bad, schema).collect()}
    assert found == {"a": "3.7", "b": "300.5", "c": "1.239"}
    with pytest.raises(Exception, match="does not fit"):
        C.conform(bad, schema).collect()
