"""Rounding, safe division and safe casts as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _nearest(value: Column, places: int) -> tuple[Column, Column, float]:
    """The nearest whole number of units of the last place, whether it is far enough from a tie to be sure, and the scale.

    Spark's ``round`` takes every double through a decimal, most of the cost of a projection that
    rounds. Off a tie both ways give the same double: the quotient of two exact numbers. Beyond 1e12 units none is sure. Few
    operations, as many roundings share a projection, whose compiled method the JVM interprets when it is too long.
    """
    scale = 10.0**places
    scaled = value * scale
    whole = F.rint(scaled)
    clear = F.abs(scaled - whole) + F.abs(scaled) * 4.99e-13 < 0.499
    # Zero loses its sign.
    return whole + 0.0, clear, scale


def half_up(value: Column, places: int) -> Column:
    """Library default: the value of Spark's own ``round``."""
    whole, clear, scale = _nearest(value, places)
    return F.when(clear, whole / scale).otherwise(F.round(value, places))


def stable(value: Column, places: int) -> Column:
    """Rounding that does not depend on the last bits of a floating-point sum.

    Rolling sums differ in their final bits from one engine (or partitioning) to another. Rounding
    four places finer first removes that noise, so equal data always gives equal output.
    """
    whole, clear, scale = _nearest(value, places)
    return F.when(clear, whole).otherwise(F.floor(F.round(value, places + 4) * scale + 0.5)) / scale


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Division that yields null on a zero denominator, also in ANSI mode."""
    return F.try_divide(numerator, denominator)


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def to_number(column: str) -> Column:
    """Double, with anything unreadable or NaN as null."""
    return null_if_nan(F.col(column).try_cast("double"))


def to_whole(value: Column) -> Column:
    """Bigint, ties to even."""
    return F.bround(value, 0).cast("bigint")
