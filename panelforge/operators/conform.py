"""Declared schemas: type mapping from catalog metadata and strict conforming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.dates import iso_text, strict_date

# Database type names and the Spark type that holds them.
TYPE_NAMES: dict[str, tuple[str, ...]] = {
    "smallint": ("smallint", "int2"),
    "int": ("integer", "int", "int4"),
    "bigint": ("bigint", "int8"),
    "float": ("real", "float4"),
    "double": ("double precision", "float8"),
    "boolean": ("boolean", "bool"),
    "date": ("date",),
    "timestamp_ntz": ("timestamp without time zone",),
    "timestamp": ("timestamp with time zone",),
    "binary": ("bytea",),
    "string": (
        "text", "character varying", "varchar", "character", "char", "bpchar", "uuid", "xml", "json",
        "jsonb", "inet", "cidr", "macaddr", "macaddr8", "name", "time with time zone", "interval",
    ),
}
SIZED_TEXT = r"^(character varying|varchar|character|char)\("
SIZED_DECIMAL = r"^(?:numeric|decimal)\((\d+),(\d+)\)$"

# Spark has no TIME type by default (microseconds of the day are kept in a
# bigint) and no decimals past 38 digits (kept losslessly as text).
TIME_OF_DAY = "time without time zone"
BARE_DECIMAL = ("numeric", "decimal")


def spark_type(data_type: Column) -> Column:
    """Spark DDL type of a database type text; NULL where unsupported."""

    name = F.lower(F.trim(data_type))
    base = F.regexp_replace(name, r"(\[\])+$", "")
    depth = ((F.length(name) - F.length(base)) / 2).cast("int")
    precision = F.regexp_extract(base, SIZED_DECIMAL, 1).try_cast("int")
    scale = F.regexp_extract(base, SIZED_DECIMAL, 2).try_cast("int")

    mapped = F.when(base.isin(*TYPE_NAMES["smallint"]), "smallint")
    for target, names in TYPE_NAMES.items():
        mapped = mapped.when(base.isin(*names), target)
    mapped = (
        mapped.when(base.rlike(SIZED_TEXT), "string")
        .when(base == TIME_OF_DAY, "bigint")
        .when(base.isin(*BARE_DECIMAL), "string")
        .when(base.rlike(SIZED_DECIMAL) & (precision <= 38), F.format_string("decimal(%d,%d)", precision, scale))
        .when(base.rlike(SIZED_DECIMAL), "string")
    )
    return F.concat(F.repeat(F.lit("array<"), depth), mapped, F.repeat(F.lit(">"), depth))


def typed_columns(columns: DataFrame) -> DataFrame:
    """Add ``spark_type`` to catalog column rows; unsupported types raise."""

    mapped = spark_type(F.col("data_type"))
    return columns.withColumn(
        "spark_type",
        # Once, not in a test and again in its branch: a method twice as long is not compiled.
        F.coalesce(mapped, F.raise_error(F.concat(F.lit("unsupported column type: "), F.col("data_type"))).cast("string")),
    )


def table_schemas(columns: DataFrame) -> DataFrame:
    """One DDL text per (library, table), columns in ordinal order.

    A group is the column list of one table, which the catalog itself bounds.
    """

    piece = F.struct(
        "ordinal_position",
        F.concat(
            F.lit("`"), F.replace(F.col("column_name"), F.lit("`"), F.lit("``")), F.lit("` "), F.col("spark_type"),
            F.when(F.col("nullable"), "").otherwise(" NOT NULL"),
        ).alias("ddl"),
    )
    grouped = typed_columns(columns).groupBy("library", "table_name").agg(
        F.count(F.lit(1)).alias("column_count"), F.array_sort(F.collect_list(piece)).alias("pieces")
    )
    ddl = F.array_join(F.transform("pieces", lambda p: p["ddl"]), ", ")
    return grouped.select(
        "library",
        "table_name",
        "column_count",
        ddl.alias("schema_ddl"),
    )


def table_schema(columns: DataFrame, library: str, table: str) -> T.StructType:
    """Declared schema of one table (a single small row reaches the driver)."""

    one = columns.where((F.col("library") == library) & (F.col("table_name") == table))
    row = table_schemas(one).first()
    if row is None:
        raise ValueError(f"no columns known for {library}.{table}")
    return T.StructType.fromDDL(row["schema_ddl"])


def _conformed(df: DataFrame, field: T.StructField) -> Column:
    source_type = df.schema[field.name].dataType
    if isinstance(field.dataType, T.DateType):
        return strict_date(F.col(field.name), source_type.typeName())
    if source_type == field.dataType:
        return F.col(field.name)
    converted = F.col(field.name).try_cast(field.dataType)
    if isinstance(field.dataType, (T.IntegralType, T.DecimalType)) and isinstance(
        source_type, (T.FractionalType, T.StringType)
    ):
        # A cut or rounded value is a failure. Both sides are compared with all digits that
        # fit beside the target's integer digits.
        whole = 20 if isinstance(field.dataType, T.IntegralType) else field.dataType.precision - field.dataType.scale
        wide = f"decimal(38,{38 - max(whole, 1)})"
        return F.when(F.col(field.name).try_cast(wide) == converted.try_cast(wide), converted)
    return converted


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared fields, order and types; all-null columns keep their type.

    A value that does not convert aborts the job with column, type and value.
    The guard is part of the column itself, so it survives any later pruning
    of other columns.
    """

    def guarded(field: T.StructField) -> Column:
        value = _conformed(df, field)
        message = F.concat(
            F.lit(f"column {field.name} does not fit {field.dataType.simpleString()}: "),
            F.col(field.name).cast("string"),
        )
        failed = F.col(field.name).isNotNull() & value.isNull()
        return (
            F.when(failed, F.raise_error(message).cast(field.dataType)).otherwise(value).alias(field.name)
        )

    return df.select(*[guarded(field) for field in schema])


def conform_problems(df: DataFrame, schema: T.StructType, samples: int = 5) -> DataFrame:
    """Per declared column: how many values do not convert, with sample values.

    One pass over the table. Failing values are counted per distinct text, combined
    before the shuffle; every distinct failing text is shuffled once. Samples are the
    smallest of them.
    """

    failures = [
        F.when(
            F.col(field.name).isNotNull() & _conformed(df, field).isNull(),
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("declared_type"),
                F.col(field.name).cast("string").alias("value"),
            ),
        )
        for field in schema
    ]
    distinct = (
        df.select(F.explode(F.array_compact(F.array(*failures))).alias("f"))
        .groupBy("f.column_name", "f.declared_type", "f.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = distinct.groupBy("column_name", "declared_type").agg(F.sum("n").alias("bad_values"))
    first = Window.partitionBy("column_name").orderBy("value")
    sampled = (
        distinct.withColumn("rn", F.row_number().over(first))
        .where(F.col("rn") <= samples)
        .groupBy("column_name")
        .agg(F.array_sort(F.collect_list("value")).alias("found"))
    )
    return totals.join(sampled, "column_name").select(
        "column_name", "declared_type", "bad_values", F.array_join("found", ", ").alias("sample_values")
    )


def dates_to_text(df: DataFrame) -> DataFrame:
    """Every date column as ISO text, for targets with a narrow date range."""

    return df.select(
        *[
            iso_text(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
            for f in df.schema
        ]
    )
