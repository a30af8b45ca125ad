"""Number parsing, fixed-point rounding and size formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spelling of a number in a text field.
NUMBER = (
    r"(?i)^\s*[+-]?(((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?|inf(inity)?)\s*$"
)
NOT_A_NUMBER = r"(?i)^\s*[+-]?nan\s*$"

# Binary size units.
KIB = 1024
MIB = 1024**2
GIB = 1024**3


# Every character that counts as white space around a field.
WHITE_SPACE = (
    " \t\n\r\f\v\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind, not only blanks."""

    return F.btrim(text, F.lit(WHITE_SPACE))


def parse_number(text: Column) -> Column:
    """Text to double; NULL where the text is not a number.

    A bare cast is too lenient (it takes ``1d``), so the spelling is checked
    first. Infinities and NaN are numbers here; callers that need finite values
    test with :func:`is_finite`.
    """

    return F.when(text.rlike(NUMBER), F.replace(text, F.lit("_"), F.lit("")).try_cast("double")).when(
        text.rlike(NOT_A_NUMBER), F.lit(float("nan"))
    )


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def missing_to_null(value: Column, type_name: str, of: Column | None = None) -> Column:
    """Treat NaN as missing in floating columns; other types pass through.

    ``of`` names the raw column when ``value`` is computed from it.
    """

    if type_name in ("float", "double"):
        return F.when(~F.isnan(value if of is None else of), value)
    return value


def quantize_half_even(value: Column, type_name: str, stored: str = "decimal(19,6)") -> Column:
    """Round half-even to six decimals through the value's decimal text.

    The text form drops binary artefacts (a float 0.1 stays 0.1). 25 fraction
    digits hold every digit a double prints next to a 6-decimal tie, and 13
    integer digits cover the widest target; larger values become NULL.

    Rounding through 38 digits is slow, and it matters only next to a tie. A
    floating value whose scaled fraction stays clear of one half by more than
    the arithmetic error rounds the same way under a plain decimal cast, so
    ordinary values take that path.
    """

    if type_name == "float":
        value = value.cast("string").cast("double")
    exact = F.bround(value.cast("string").try_cast("decimal(38,25)"), 6).try_cast(stored)
    if type_name not in ("float", "double"):
        return exact
    scaled = value * F.lit(1e6)
    from_tie = F.lit(0.5) - F.abs(scaled - F.rint(scaled))
    # The product and the printed digits are each off by at most one unit in
    # the last place, 2**-52 of the value; 2**-49 leaves room.
    clear = from_tie > F.abs(scaled) * F.lit(2.0**-49) + F.lit(1e-9)
    return F.when(clear, value.try_cast(stored)).otherwise(exact)


def pretty_bytes(byte_count: Column) -> Column:
    """Render a byte count as GiB, MiB or KiB with two decimals, else plain B."""

    def scaled(unit: int, name: str) -> Column:
        # Ties go to the even digit; the formatter alone would round them up.
        return F.format_string(f"%.2f {name}", F.bround(byte_count / F.lit(float(unit)), 2))

    return (
        F.when(byte_count >= GIB, scaled(GIB, "GiB"))
        .when(byte_count >= MIB, scaled(MIB, "MiB"))
        .when(byte_count >= KIB, scaled(KIB, "KiB"))
        .otherwise(F.format_string("%d B", byte_count.cast("bigint")))
    )


def whole_or_zero(value: Column) -> Column:
    """Coerce to bigint, unparseable or missing becomes 0."""

    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))
