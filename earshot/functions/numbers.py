"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits kept of a floating-point input before it is added up.
INPUT_DIGITS = 9


def round_to_long(value: Column) -> Column:
    """Nearest integer, halves away from zero, as bigint.

    A plain cast truncates. `round` gives the same values but goes through a
    decimal per row; splitting off the fraction is exact and about four times
    faster. NaN and out-of-range values raise in the cast, as in ANSI SQL.
    """
    size = F.abs(value)
    whole = size.cast("long")
    nearest = whole + (size - whole >= 0.5).cast("long")
    return F.when(value < 0, -nearest).otherwise(nearest)


def safe_long(text: Column) -> Column:
    """Text to bigint, NULL where the text is not a whole number."""
    return text.try_cast("long")


def scaled_long(value: Column, digits: int = INPUT_DIGITS) -> Column:
    """A number as a whole number of units of its last digit, so that sums are exact in any order.

    NaN and infinite values are missing.
    """
    if digits == 0:
        return value.try_cast("long")
    # the cast cuts towards zero
    return (value * float(10**digits) + F.signum(value) * 0.5).try_cast("long")


def rounded_quotient(part: Column, whole: Column, digits: int, unit: int = 1) -> Column:
    """part / (whole * unit) of integers, rounded once, halves away from zero, as double.

    The quotient is rounded in whole numbers of the last digit, so nothing depends on
    binary fractions. NULL for a zero or missing denominator.
    """
    size = F.abs(part).cast("decimal(26,0)") * F.lit(2 * 10**digits).cast("decimal(11,0)")
    below = whole.cast("decimal(20,0)") * F.lit(unit).cast("decimal(15,0)")
    nearest = F.call_function("div", size + below, F.nullif(below, F.lit(0).cast("decimal(1,0)")) * 2)
    signed = F.when(part < 0, -nearest).otherwise(nearest)
    return signed.cast("double") / float(10**digits)


def rounded_ratio(part: Column | str, whole: Column | str, digits: int) -> Column:
    """part / whole of integers, rounded; NULL for a zero or missing denominator."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return rounded_quotient(part, whole, digits)


def percent(share: Column | str) -> Column:
    """A 0-1 share as percent."""
    return (F.col(share) if isinstance(share, str) else share) * 100
