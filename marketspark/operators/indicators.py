"""Technical indicators.

Each indicator is declared in layers: window columns over the input, window columns over those, and
result columns, each step of which may use the one before. ``stack`` evaluates the window layers of
any number of indicators together, so the whole set costs one shuffle, one sort and three window passes.
"""

from dataclasses import dataclass, field
from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import ma_signal, vwap_signal
from ..functions.numeric import half_up, safe_div
from .projections import unused
from .windows import series, trailing


@dataclass(frozen=True)
class Indicator:
    rolling: dict[str, Column]
    results: tuple[dict[str, Column], ...]
    chained: dict[str, Column] = field(default_factory=dict)
    #: Results that the second windows read.
    early: dict[str, Column] = field(default_factory=dict)
    #: The second windows and results come before those of others, in a pass and a projection of their own.
    apart: bool = False


def stack(df: DataFrame, *indicators: Indicator) -> DataFrame:
    rolling = {name: column for one in indicators for name, column in one.rolling.items()}
    chained = {name: column for one in indicators for name, column in one.chained.items()}
    kept = [F.col(name) for name in df.columns] + [F.col(name) for one in indicators for step in (one.early, *one.results) for name in step]
    clashing = [name for name in df.columns if name in rolling or name in chained]
    if clashing:
        # The caller's own columns of these names wait in a struct.
        aside = unused(df, "_aside")
        kept = [F.col(f"{aside}.{name}").alias(name) if name in clashing else column for name, column in zip(df.columns, kept)] + kept[len(df.columns) :]
        df = df.withColumn(aside, F.struct(*clashing)).drop(*clashing)
    df = df.withColumns(rolling)
    # Results that need no second pass are projected before it: projections between the windows compile to shorter methods than one.
    second = [one for one in indicators if one.chained]
    for some in ([one for one in indicators if not one.chained], [one for one in second if one.apart], [one for one in second if not one.apart]):
        for windows in ("early", "chained"):
            df = df.withColumns({name: column for one in some for name, column in getattr(one, windows).items()})
        for steps in zip_longest(*[one.results for one in some], fillvalue={}):
            df = df.withColumns({name: column for step in steps for name, column in step.items()})
    return df.select(*kept)


def rsi_of(price="close", period=14, by=("ticker",), rounding=half_up) -> Indicator:
    """Relative strength from plain means of gains and losses; no losses means a strength of 100."""
    change = F.col(price) - F.col("_previous")
    window = trailing(period, by)
    zero = F.lit(0.0)  # greatest() skips nulls, so the first bar has no gain and no loss
    strength = F.coalesce(safe_div(F.col("_gain"), F.col("_loss")), F.lit(100.0))
    return Indicator(
        rolling={"_previous": F.lag(price).over(series(by))},
        chained={
            "_gain": F.avg(F.greatest(change, zero)).over(window),
            "_loss": F.avg(F.greatest(-change, zero)).over(window),
        },
        results=({f"rsi_{period}": rounding(100 - 100 / (1 + strength), 2)},),
    )


def macd_of(price="close", fast=12, slow=26, signal=9, by=("ticker",), rounding=half_up) -> Indicator:
    """Difference of two simple means; the signal is the mean of the rounded line."""
    line = rounding(F.col("_fast") - F.col("_slow"), 4)
    return Indicator(
        rolling={
            "_fast": F.avg(price).over(trailing(fast, by)),
            "_slow": F.avg(price).over(trailing(slow, by)),
        },
        early={"macd_line": line},
        chained={"_signal": F.avg("macd_line").over(trailing(signal, by))},
        results=(
            {"macd_signal": rounding(F.col("_signal"), 4)},
            {"macd_histogram": rounding(F.col("macd_line") - F.col("macd_signal"), 4)},
        ),
    )


def bollinger_of(price="close", period=20, num_std=2.0, by=("ticker",), rounding=half_up) -> Indicator:
    """Bands around the rounded mean; widths are null where they would divide by zero."""
    window = trailing(period, by)
    middle, upper, lower = F.col("bb_middle"), F.col("bb_upper"), F.col("bb_lower")
    return Indicator(
        rolling={"_mean": F.avg(price).over(window), "_spread": F.stddev_samp(price).over(window)},
        results=(
            {"bb_middle": rounding(F.col("_mean"), 4)},
            {
                "bb_upper": rounding(middle + num_std * F.col("_spread"), 4),
                "bb_lower": rounding(middle - num_std * F.col("_spread"), 4),
            },
            {
                "bb_bandwidth": rounding(safe_div(upper - lower, middle) * 100, 4),
                "bb_pct_b": rounding(safe_div(F.col(price) - lower, upper - lower), 4),
            },
        ),
    )


def vwap_of(window=20, by=("ticker",), rounding=half_up) -> Indicator:
    """Volume-weighted typical price. A bar without typical price still counts its volume."""
    rows = trailing(window, by)
    return Indicator(
        rolling={
            "_turnover": F.sum(F.col("typical_price") * F.col("volume")).over(rows),
            "_volume": F.sum("volume").over(rows),
        },
        results=(
            {"vwap": rounding(safe_div(F.col("_turnover"), F.col("_volume")), 4)},
            {"vwap_signal": vwap_signal(F.col("close"), F.col("vwap"))},
        ),
    )


def moving_averages_of(price="close", fast=50, slow=200, by=("ticker",), rounding=half_up) -> Indicator:
    """Two plain means. A window takes as many steps a row as its frame has rows, so where ``slow`` is a multiple of ``fast`` its sum is
    that of the fast window here and those so many rows back; no sum is ever subtracted, so that nothing cancels."""
    quick, steady = f"sma_{fast}", f"sma_{slow}"
    window = trailing(fast, by)
    rolling = {"_sma_fast": F.avg(price).over(window)}
    chained, backs = {}, range(fast, slow, fast)
    if slow % fast:
        rolling["_sma_slow"], mean = F.avg(price).over(trailing(slow, by)), F.col("_sma_slow")
    else:
        rolling |= {"_fast_sum": F.sum(price).over(window), "_fast_rows": F.count(price).over(window)}
        for back in backs:
            chained[f"_sum_{back}"] = F.lag("_fast_sum", back).over(series(by))
            chained[f"_rows_{back}"] = F.lag("_fast_rows", back, 0).over(series(by))
        total, rows = F.coalesce("_fast_sum", F.lit(0.0)), F.col("_fast_rows")
        for back in backs:
            total, rows = total + F.coalesce(f"_sum_{back}", F.lit(0.0)), rows + F.col(f"_rows_{back}")
        mean = safe_div(total, rows)
    return Indicator(
        rolling=rolling,
        chained=chained,
        apart=True,
        results=(
            {quick: rounding(F.col("_sma_fast"), 4), steady: rounding(mean, 4)},
            {"ma_signal": ma_signal(F.col(quick), F.col(steady))},
        ),
    )


def rsi(df: DataFrame, price="close", period=14, by=("ticker",), rounding=half_up) -> DataFrame:
    return stack(df, rsi_of(price, period, by, rounding))


def macd(df: DataFrame, price="close", fast=12, slow=26, signal=9, by=("ticker",), rounding=half_up) -> DataFrame:
    return stack(df, macd_of(price, fast, slow, signal, by, rounding))


def bollinger(df: DataFrame, price="close", period=20, num_std=2.0, by=("ticker",), rounding=half_up) -> DataFrame:
    return stack(df, bollinger_of(price, period, num_std, by, rounding))


def vwap(df: DataFrame, window=20, by=("ticker",), rounding=half_up) -> DataFrame:
    return stack(df, vwap_of(window, by, rounding))


def moving_averages(df: DataFrame, price="close", fast=50, slow=200, by=("ticker",), rounding=half_up) -> DataFrame:
    return stack(df, moving_averages_of(price, fast, slow, by, rounding))
