"""Row filters and validation rules."""

from collections.abc import Iterable, Mapping
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv



def price_rules() -> dict[str, Column]:
    def positive(name):
        return F.coalesce(F.col(name) > 0, F.lit(True))

    return {
        "ticker_length": F.length("ticker").between(1, 15),
        "open_positive": positive("open"),
        "high_positive": positive("high"),
        "low_positive": positive("low"),
        "close_positive": F.coalesce(F.col("close") > 0, F.lit(False)),
        "volume_not_negative": F.coalesce(F.col("volume") >= 0, F.lit(True)),
    }


def missing_columns(df: DataFrame, columns) -> list[str]:
    return [name for name in columns if name not in df.columns]


def drop_null_keys(df: DataFrame, columns=("date", "close", "ticker")) -> DataFrame:
    """Rows with all keys present; NaN counts as missing."""
    return df.dropna(subset=list(columns))


def positive_close(df: DataFrame) -> DataFrame:
    return df.filter(F.col("close") > 0)


def ohlc_holds() -> Column:
    return F.coalesce(F.col("high") >= F.col("low"), F.lit(True))


def valid_ohlc(df: DataFrame) -> DataFrame:
    """High at or above low, or one of them unknown."""
    return df.filter(ohlc_holds())


def failed_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules a row breaks, in the order given."""
    marks = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return F.array_compact(F.array(*marks))


def follows_all(rules: Mapping[str, Column]) -> Column:
    return reduce(lambda left, right: left & right, rules.values())


def apply_rules(df: DataFrame, rules: Mapping[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy all rules, and the rest with the rules they break."""
    rules = rules or price_rules()
    passes = F.coalesce(follows_all(rules), F.lit(False))
    return df.filter(passes), df.filter(~passes).withColumn("failed_rules", failed_rules(rules))


def has_return(df: DataFrame) -> DataFrame:
    return df.filter(F.col("daily_return").isNotNull())


def has_title(df: DataFrame, column: str = "title") -> DataFrame:
    return df.filter(F.col(column) != "")


def for_ticker(df: DataFrame, ticker: str) -> DataFrame:
    return df.filter(F.col("ticker") == F.lit(ticker.upper()))


def for_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def in_universe(df: DataFrame, universe: DataFrame | Iterable[str] = fv.TICKERS) -> DataFrame:
    """Rows of the given tickers. A DataFrame is semi-joined, its strategy left to its measured size."""
    if isinstance(universe, DataFrame):
        return df.join(universe.select("ticker"), "ticker", "left_semi")
    return for_values(df, "ticker", universe)


def between_dates(df: DataFrame, start=None, end=None, column: str = "date") -> DataFrame:
    """Inclusive range of days.

    The column is compared as it is, so that the bounds reach the Parquet scan; on a table partitioned
    by year they also prune its folders.
    """
    kind = dict(df.dtypes)[column]
    value = F.col(column).cast("date") if kind == "string" else F.col(column)
    kind = "date" if kind == "string" else kind

    def day(bound):
        return bound if isinstance(bound, date) else date.fromisoformat(bound)

    if start is not None:
        df = df.filter(value >= F.lit(str(day(start))).cast(kind))
    if end is not None:
        df = df.filter(value < F.lit(str(day(end) + timedelta(days=1))).cast(kind))
    if "year" in df.columns:
        if start is not None:
            df = df.filter(F.col("year") >= day(start).year)
        if end is not None:
            df = df.filter(F.col("year") <= day(end).year)
    return df


def in_years(df: DataFrame, years: Iterable[int], column: str = "date") -> DataFrame:
    """From the first day of the earliest year to the last day of the latest."""
    years = list(years)
    return between_dates(df, f"{min(years)}-01-01", f"{max(years)}-12-31", column)


def last_days(df: DataFrame, n: int = fv.NEWS_DAYS, column: str = "published_at", as_of=None) -> DataFrame:
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return df.filter(F.col(column).cast("date") >= F.date_sub(today, n))


def gainers(movers: DataFrame) -> DataFrame:
    return movers.filter(F.col("mover_type") == "top_gainer")


def losers(movers: DataFrame) -> DataFrame:
    return movers.filter(F.col("mover_type") == "top_loser")
