"""Classifiers: numbers to labels."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _side(left: Column, right: Column, above: str, below: str, level: str) -> Column:
    # A null on either side compares to null, so it falls through to `level`.
    return F.when(left > right, above).when(left < right, below).otherwise(level)


def vwap_signal(close: Column, vwap: Column) -> Column:
    return _side(close, vwap, "above", "below", "at")


def ma_signal(fast: Column, slow: Column) -> Column:
    return _side(fast, slow, "golden", "death", "neutral")


def rsi_band(rsi: Column, high: float = 70, low: float = 30) -> Column:
    return F.when(rsi > high, "overbought").when(rsi < low, "oversold").otherwise("neutral")


def macd_sign(line: Column) -> Column:
    return F.when(line > 0, "bullish").otherwise("bearish")


def mover_type(gainer_rank: Column, loser_rank: Column, k: int = 10) -> Column:
    """A row that is in both lists counts as a gainer."""
    return (
        F.when(gainer_rank <= k, "top_gainer").when(loser_rank <= k, "top_loser").otherwise("neutral")
    )
