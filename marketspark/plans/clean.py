"""Bronze prices to silver prices."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from ..functions import prices
from ..operators import filters as fl
from ..operators.projections import safe_cast, with_audit
from ..operators.windows import arrival_columns, daily_return, dedup_last, over_series

KEYS = ("date", "close", "ticker")

#: Rows of a ticker, more than its calendar has days, from which on copies of its bars are dropped before the shuffle by ticker.
CROWDED = 1 << 20


def enrich(df: DataFrame, rounding=half_up, max_rows: int | None = None) -> DataFrame:
    """Daily return and per-bar features; ``max_rows`` as for the indicators."""
    returned = over_series(df, lambda bars, by: daily_return(bars, by, rounding), 1, max_rows)
    return returned.withColumns(
        {"price_range": prices.price_range(rounding), "typical_price": prices.typical_price(rounding)}
    ).withColumn("range_pct", prices.range_pct(rounding, F.col("price_range")))


def _drop_reason() -> Column:
    """Why a row is dropped before de-duplication, or null."""
    no_key = F.col("date").isNull() | F.col("close").isNull() | F.col("ticker").isNull()
    return (
        F.when(no_key, "null").when(F.col("close") <= 0, "zero").when(~fl.ohlc_holds(), "ohlc")
    )


def _empty(df: DataFrame) -> DataFrame:
    return safe_cast(
        df.sparkSession.createDataFrame([], "date timestamp_ntz, ticker string, close double")
    ).limit(0)


def survivors(df: DataFrame, order=("ingested_at",)) -> DataFrame:
    """Typed rows with all keys, a positive close and sane highs and lows; one per ticker and date."""
    return dedup_last(_typed(df), ("ticker", "date"), order)


def _typed(df: DataFrame) -> DataFrame:
    return safe_cast(df).filter(_drop_reason().isNull())


def _by_ticker(df: DataFrame, order, keys=("ticker", "date")) -> DataFrame:
    """The last copy of each bar, in a shuffle by ticker. Of crowded tickers, whose names are broadcast, no other copies enter it."""
    sizes = df.groupBy("ticker").agg(F.count(F.lit(1)).alias("rows"))
    crowded = F.broadcast(sizes.filter(F.col("rows") > CROWDED).select("ticker"))
    last = dedup_last(df.join(crowded, "ticker", "left_semi"), keys, order)
    shuffled = df.join(crowded, "ticker", "left_anti").unionByName(last).select(*df.columns).repartition("ticker")
    return dedup_last(shuffled, keys, order)


def clean_prices(df: DataFrame, source: str, order=("ingested_at",), rounding=half_up, audit=True,
                 max_rows: int | None = None, previous: DataFrame | None = None) -> DataFrame:
    """Cast, drop bad rows, de-duplicate (last to arrive wins), validate, enrich, tag with the source.

    A batch without date, ticker or close gives an empty result of the full shape. ``previous``: the clean bar before the
    batch of each ticker, whose close the first return needs.

    The rows of a ticker meet in one shuffle and one sort, for the last copy of a bar and for the returns; before it the rows of
    each ticker are counted, so that a bar of very many copies is not gathered. With ``max_rows`` copies are dropped in a
    shuffle of their own.
    """
    if fl.missing_columns(df, KEYS):
        df, order = _empty(df), ()
    added = {"silver_processed_at": None, "data_source": source} if audit else {"data_source": source}
    passes = F.coalesce(fl.follows_all(fl.price_rules()), F.lit(False))
    if previous is None:
        one = survivors(df, order) if max_rows is not None else _by_ticker(_typed(df), order)
        return with_audit(enrich(one.filter(passes), rounding, max_rows), **added)
    kept, mark = _typed(df), F.col("_earlier")
    earlier = previous.select(*[name for name in kept.columns if name in previous.columns], F.lit(True).alias("_earlier"))
    if max_rows is not None:
        valid = survivors(df, order).filter(passes).withColumn("_earlier", F.lit(False))
        both = valid.unionByName(earlier, allowMissingColumns=True)
    else:
        # Earlier bars share the shuffle; they are neither copies of the batch's bars nor judged again.
        landed = kept.withColumn("_earlier", F.lit(False)).unionByName(earlier, allowMissingColumns=True)
        both = _by_ticker(landed, order, ("ticker", "date", "_earlier")).filter(passes | mark)
    return with_audit(enrich(both, rounding, max_rows).filter(~mark).drop("_earlier"), **added)


def rejects(df: DataFrame, order=("ingested_at",)) -> DataFrame:
    """Rows that pass every earlier step and then fail a validation rule, with the rules they fail."""
    return fl.apply_rules(survivors(df, order))[1]


def clean_stats(df: DataFrame, source: str, order=("ingested_at",)) -> DataFrame:
    """One row: input, output and the rows each step drops, from a single pass.

    Dropped rows collapse to one row per reason, and copies of a bar to one row, before the shuffle.
    """
    names = ("input_rows", "output_rows", "dropped_nulls", "dropped_zeros", "dropped_ohlc", "dropped_dupes", "validation_errors")
    if fl.missing_columns(df, KEYS):
        # Only the size of the batch is known.
        return df.agg(
            F.lit(source).alias("source"),
            F.count(F.lit(1)).alias("input_rows"),
            *[F.lit(0).cast("bigint").alias(name) for name in names[1:]],
        )
    cast = safe_cast(df)
    known = arrival_columns(cast, order)
    others = [name for name in cast.columns if name not in ("ticker", "date")]
    arrival = F.struct(*known, *sorted(name for name in others if name not in known))
    kept = F.col("_reason").isNull()
    marked = cast.withColumns({"_reason": _drop_reason(), "_arrival": arrival}).withColumn(
        "_last", F.when(kept, F.struct(F.col("_arrival"), fl.follows_all(fl.price_rules()).alias("ok")))
    )
    bars = marked.groupBy(
        "_reason", F.when(kept, F.col("ticker")).alias("_ticker"), F.when(kept, F.col("date")).alias("_date")
    ).agg(F.count(F.lit(1)).alias("_rows"), F.max("_last").alias("_last"))

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_rows"))), F.lit(0)).cast("bigint")

    reason = F.col("_reason")
    return bars.agg(
        F.lit(source).alias("source"),
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("input_rows"),
        F.count_if(kept & F.col("_last.ok")).alias("output_rows"),
        rows(reason == "null").alias("dropped_nulls"),
        rows(reason.isin("zero", "ohlc")).alias("dropped_zeros"),
        rows(reason == "ohlc").alias("dropped_ohlc"),
        (rows(kept) - F.count_if(kept)).alias("dropped_dupes"),
        F.count_if(kept & ~F.col("_last.ok")).alias("validation_errors"),
    )

