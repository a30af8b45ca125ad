"""Strict, null-preserving normalization of source columns.

Each rule contributes a typed column and a check that tells bad input. Checks
are plain boolean expressions, so separating good rows, listing violations and
failing a load are narrow passes from scan to result with no shuffle, and a
row's checks are evaluated once in each of them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.dates import lenient_date
from panelforge.functions.numbers import missing_to_null, parse_number, quantize_half_even
from panelforge.plans.contracts import RULES, SOURCE_COLUMNS, FamilyRules

INTEGER_TYPES = ("byte", "short", "integer", "long")
FLOATING_TYPES = ("float", "double")


@dataclass(frozen=True)
class Check:
    """One way a value of a column can be bad; ``bad`` is NULL or false for a missing value.

    Checks are kept short on purpose: all of them meet in one generated method
    per stage, and the JVM only compiles methods below a size limit.
    """

    column_name: str
    problem: str
    bad: Column


@dataclass
class Normalized:
    """Source rows with the typed columns and checks that apply to them."""

    source: DataFrame
    typed: dict[str, Column] = field(default_factory=dict)
    checks: list[Check] = field(default_factory=list)
    source_year: int | None = None

    def any_bad(self) -> Column:
        if not self.checks:
            return F.lit(False)
        return F.coalesce(reduce(Column.__or__, [c.bad for c in self.checks]), F.lit(False))

    def columns(self) -> list[Column]:
        chosen = [self.typed.get(name, F.col(name)).alias(name) for name in self.source.columns]
        if self.source_year is not None:
            chosen.insert(0, F.lit(self.source_year).cast("smallint").alias("source_year"))
        return chosen


def _kind(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.typeName()


def _number(df: DataFrame, name: str) -> Column:
    """Column as a number; text is parsed strictly."""

    return parse_number(F.col(name)) if _kind(df, name) == "string" else F.col(name)


def _numeric(df: DataFrame, name: str) -> Column:
    """Column as a number with NaN as missing."""

    kind = _kind(df, name)
    return missing_to_null(_number(df, name), "double" if kind == "string" else kind)


def _rejects(df: DataFrame, name: str, accepted: Column) -> Column:
    """True where a value is present (neither NULL nor NaN) and not accepted.

    ``accepted`` is NULL for a NULL value. Only text can also make it NULL by
    not being a number, so only text needs the longer form.
    """

    kind = _kind(df, name)
    if kind == "string":
        return F.col(name).isNotNull() & F.coalesce(~accepted, F.lit(True))
    if kind in FLOATING_TYPES:
        return ~(F.isnan(F.col(name)) | accepted)
    return ~accepted


# The problem texts of the rules below are fixed output: reports are compared by them.


def integer_rule(df: DataFrame, name: str, minimum: int, maximum: int, stored: str) -> tuple[Column, Check]:
    """Whole number within a closed range."""

    value = _number(df, name)
    low, high = (F.lit(str(limit)).cast("decimal(20,0)") for limit in (minimum, maximum))
    accepted = value.between(low, high)
    if _kind(df, name) not in INTEGER_TYPES:
        # Range first: the remainder of an infinity is NaN.
        accepted = accepted & (value % 1 == 0)
    problem = (
        f"must contain whole non-negative values no greater than {maximum}"
        if minimum == 0
        else f"must contain whole values between {minimum} and {maximum}"
    )
    return _numeric(df, name).try_cast(stored), Check(name, problem, _rejects(df, name, accepted))


def decimal_rule(df: DataFrame, name: str, minimum: str, maximum: str, stored: str) -> tuple[Column, Check]:
    """Six-decimal fixed point, rounded half-even, within a closed range."""

    value, kind = F.col(name), _kind(df, name)
    # Half a unit beyond either limit. The largest allowed digit is odd and the
    # smallest even, so a tie at the top leaves the range and one at the bottom
    # stays in it.
    half_unit = Decimal("0.0000005")
    low, high = (
        F.lit(str(limit)).cast("decimal(38,20)") for limit in (Decimal(minimum) - half_unit, Decimal(maximum) + half_unit)
    )
    digits = value.cast("string").try_cast("decimal(38,20)")
    accepted = F.coalesce((digits >= low) & (digits < high), value.isNull())
    if kind in (*FLOATING_TYPES, *INTEGER_TYPES):
        # Ordinary values are well inside the limits and skip the exact test.
        accepted = (F.abs(value) < F.lit(float(maximum.split(".")[0]))) | accepted
    typed = missing_to_null(quantize_half_even(value, kind, stored), kind, of=value)
    problem = f"must fit six decimals between {minimum} and {maximum}"
    return typed, Check(name, problem, _rejects(df, name, accepted))


def date_rule(df: DataFrame, name: str) -> tuple[Column, Check]:
    typed = lenient_date(F.col(name), _kind(df, name))
    return typed, Check(name, "must contain dates", typed.isNull() & F.col(name).isNotNull())


def domain_rule(df: DataFrame, name: str, allowed: Iterable[str]) -> tuple[Column, Check]:
    text, allowed = F.col(name).cast("string"), list(allowed)
    problem = f"contains unexpected values; allowed: {', '.join(allowed)}"
    return text, Check(name, problem, ~text.isin(allowed))


def flag_rule(df: DataFrame, name: str) -> Check:
    accepted = _number(df, name).isin(0, 1)
    return Check(name, "must contain only documented 0/1 flag values", _rejects(df, name, accepted))


def normalize(df: DataFrame, rules: FamilyRules) -> Normalized:
    """Bind rules to a table.

    Columns the rules do not name pass through, rules without a column are
    skipped, column order is kept.
    """

    result = Normalized(df)

    def add(name: str, rule: tuple[Column, Check]) -> None:
        result.typed[name] = rule[0]
        result.checks.append(rule[1])

    present = set(df.columns)
    for name, allowed in rules.domains.items():
        if name in present:
            add(name, domain_rule(df, name, allowed))
    for name, limits in rules.integers.items():
        if name in present:
            add(name, integer_rule(df, name, *limits))
    result.checks.extend(flag_rule(df, name) for name in rules.flags if name in present)
    for name, limits in rules.decimals.items():
        if name in present:
            add(name, decimal_rule(df, name, *limits))
    for name in rules.dates:
        if name in present:
            add(name, date_rule(df, name))
    for name, stored in rules.floats.items():
        if name in present:
            result.typed[name] = _numeric(df, name).cast(stored)
    return result


def normalize_family(df: DataFrame, family: str, source_year: int | None = None) -> Normalized:
    """Apply one family's contract and rules; the year, where given, goes in front.

    Every column of the contract must be there; a source that lacks one fails by name
    instead of loading NULLs.
    """

    missing = [name for name in SOURCE_COLUMNS[family] if name not in df.columns]
    if missing:
        raise ValueError(f"{family} source lacks contract columns: {', '.join(missing)}")
    result = normalize(df.select(*SOURCE_COLUMNS[family]), RULES[family])
    result.source_year = source_year
    return result


def valid_rows(normalized: Normalized) -> DataFrame:
    """Typed rows that pass every check."""

    return normalized.source.where(~normalized.any_bad()).select(*normalized.columns())


def violation_rows(normalized: Normalized, keys: Iterable[str] = ()) -> DataFrame:
    """One row per violation: key columns, column_name, problem, value.

    Every check yields a struct or NULL and the NULLs are dropped after the
    explode, so each check is evaluated once and nothing is filtered twice.
    """

    found = F.array(
        *[
            F.when(
                c.bad,
                F.struct(
                    F.lit(c.column_name).alias("column_name"),
                    F.lit(c.problem).alias("problem"),
                    F.col(c.column_name).cast("string").alias("value"),
                ),
            )
            for c in normalized.checks
        ]
    )
    return (
        normalized.source.select(*keys, F.explode(found).alias("v"))
        .where(F.col("v").isNotNull())
        .select(*keys, "v.column_name", "v.problem", "v.value")
    )


def strict_rows(normalized: Normalized) -> DataFrame:
    """Typed rows for a load that must fail as a whole on the first bad value.

    The check rides in the same pass as the write, so a bad source aborts the
    job before anything is committed. It sits in the filter, where column
    pruning cannot remove it.
    """

    clean = F.lit(True)
    if normalized.checks:
        clean = reduce(
            lambda chain, c: chain.when(
                c.bad,
                F.raise_error(
                    F.concat(F.lit(f"{c.column_name} {c.problem}, got "), F.col(c.column_name).cast("string"))
                ).cast("boolean"),
            ),
            normalized.checks,
            F,
        ).otherwise(True)
    return normalized.source.where(clean).select(*normalized.columns())
