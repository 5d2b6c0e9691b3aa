"""Per-bar price features."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import half_up, safe_div


def price_range(rounding=half_up) -> Column:
    return rounding(F.col("high") - F.col("low"), 4)


def typical_price(rounding=half_up) -> Column:
    return rounding((F.col("high") + F.col("low") + F.col("close")) / 3, 4)


def range_pct(rounding=half_up, rounded_range: Column | None = None) -> Column:
    """Range as a percentage of close, from the already rounded range."""
    span = price_range(rounding) if rounded_range is None else rounded_range
    return rounding(safe_div(span, F.col("close")) * 100, 4)
