"""The full indicator set over silver prices."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from ..operators import indicators as ind
from ..operators.projections import cast_prices, with_audit
from ..operators.windows import latest_n, over_series, with_look_back

#: Rows before a bar that any of its indicators can depend on (the 200-row mean).
LOOK_BACK = 199

#: Columns that windows read. The rows before a first bar give no bars, so that theirs are all they need.
LOOKED_BACK_ON = ("close", "volume", "typical_price")


def add_indicators(df: DataFrame, start=None, max_rows: int | None = None, by=("ticker",), rounding=half_up, audit=True) -> DataFrame:
    """All indicators, one output row per input row.

    ``start``: only bars from this date on, computed from the rows they look back on instead of the
    whole history.

    ``max_rows``: cut series longer than this. Daily bars are unique per ticker and day, so a series
    is bounded by the calendar and needs no cut; pass a limit for series that are not.
    """

    def compute(bars, by):
        return ind.stack(
            bars,
            ind.rsi_of(by=by, rounding=rounding),
            ind.macd_of(by=by, rounding=rounding),
            ind.bollinger_of(by=by, rounding=rounding),
            ind.vwap_of(by=by, rounding=rounding),
            ind.moving_averages_of(by=by, rounding=rounding),
        )

    df = cast_prices(df)
    if start is not None:
        df = with_look_back(df, start, LOOK_BACK, by, columns=LOOKED_BACK_ON)
    df = over_series(df, compute, LOOK_BACK, max_rows, by)
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(start).cast("timestamp_ntz"))
    return with_audit(df, indicators_computed_at=None) if audit else df


def latest_indicators(df: DataFrame, n: int = 1, by=("ticker",), rounding=half_up) -> DataFrame:
    """Indicators of the last n bars of every series, without computing its history.

    Each task passes on at most ``LOOK_BACK + n`` bars per series, so the shuffle does not grow with
    the length of the history.
    """
    return latest_n(add_indicators(latest_n(df, LOOK_BACK + n, by), by=by, rounding=rounding, audit=False), n, by)
