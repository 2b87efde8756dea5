"""Numeric expressions: rounding, exact sums, guarded ratios, lenient casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed-point grid for money sums. Adding doubles gives another last bit for every task order;
# adding decimals does not, so a retried or re-partitioned job returns the same cents.
MONEY = "decimal(18,4)"


def np_round(value: Column, digits: int) -> Column:
    """Half-to-even rounding of a double. ``round`` is half-up and ``bround`` goes through decimal."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def exact_sum(value: Column) -> Column:
    """Sum of a double money column; plain double sum for a group with a value off the grid.

    A value is on the grid if the decimal gives the same double back.
    """
    fixed = value.try_cast(MONEY)
    fixed = F.when(fixed.cast("double") == value, fixed)
    return F.when(
        F.count(fixed) == F.count(value), F.sum(fixed).cast("double")
    ).otherwise(F.sum(value))


def exact_mean(value: Column) -> Column:
    """Mean of the non-null values, summed exactly; null for a group without values."""
    n = F.count(value)
    return F.when(n > 0, exact_sum(value) / F.greatest(n, F.lit(1)))


def sum_or_zero(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100``, and 0 when there is no positive whole."""
    return F.when(whole > 0, F.try_divide(part.cast("double"), whole) * 100).otherwise(F.lit(0.0))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.try_divide(part.cast("double"), whole)).otherwise(F.lit(0.0))


# A failed cast raises and catches inside the JVM, several microseconds per value; a pattern test
# first keeps text that is not a number off that path.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_DIGITS = r"^[+-]?\d+$"
_DIGITS_POINT_ZERO = r"^[+-]?\d+\.0*$"


def to_number(value: Column) -> Column:
    """Double, or null when the text is not a number."""
    return F.when(value.rlike(_NUMBER), value.try_cast("double"))


def to_whole_number(value: Column) -> Column:
    """Bigint from digits or an integral float text; null for fractions and other text."""
    number = value.try_cast("double")
    return (
        F.when(value.rlike(_DIGITS), value.try_cast("bigint"))
        .when(value.rlike(_DIGITS_POINT_ZERO), F.substring_index(value, ".", 1).try_cast("bigint"))
        .when(value.rlike(_NUMBER), F.when(number == F.floor(number), number.try_cast("bigint")))
    )


def python_float(value: Column) -> Column:
    """Shortest text of a double: an exponent, of two digits or more, only below 1e-4 and from 1e16 on."""
    java = value.cast("string")  # with an exponent below 1e-3 and from 1e7 on
    plain = value.try_cast("decimal(38,20)").cast("string")
    trimmed = F.regexp_replace(plain, r"(\.\d+?)0+$", "$1")
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    power = F.substring_index(java, "E", -1)
    sign = F.when(power.startswith("-"), "-").otherwise("+")
    digits = F.ltrim(power, F.lit("-"))
    scientific = F.concat(mantissa, F.lit("e"), sign, F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits))
    size = F.abs(value)
    return (
        F.when(~java.contains("E"), java)
        .when((size >= 1e-4) & (size < 1e16), trimmed)
        .otherwise(scientific)
    )
