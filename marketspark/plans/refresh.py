"""The daily refresh as plain Spark jobs: clean, indicators, marts, checks."""

from pyspark.sql import DataFrame

from ..functions.numeric import half_up
from ..operators import quality as q
from ..operators.combine import latest_partition, union_sources
from ..operators.projections import stg_prices
from ..sources import readers, writers
from .clean import clean_prices, clean_stats
from .indicators import add_indicators
from .marts import mart_daily_returns, mart_top_movers


def refresh_source(bronze: DataFrame, source: str, root: str, order=("ingested_at",), rounding=half_up, max_rows: int | None = None) -> None:
    """Silver and gold of one feed. ``max_rows`` cuts series that are no daily bars, as for the indicators."""
    spark = bronze.sparkSession
    cleaned = clean_prices(bronze, source, order, rounding, max_rows=max_rows)
    writers.write_silver(cleaned, f"{root}/silver/prices/{source}", dealt=True)
    silver = readers.read_silver(spark, root, source).drop("year")
    gold = add_indicators(silver, max_rows=max_rows, rounding=rounding)
    writers.write_gold(gold, f"{root}/gold/indicators/{source}")


def refresh_marts(silver: DataFrame, root: str, rounding=half_up) -> dict[str, DataFrame]:
    """Both marts, written and read back. The movers read only the last year's partition."""
    spark = silver.sparkSession
    stg = stg_prices(silver, rounding)
    last_year = stg_prices(latest_partition(silver), rounding)
    marts = {
        "mart_daily_returns": mart_daily_returns(stg, rounding),
        "mart_top_movers": mart_top_movers(last_year, rounding=rounding),
    }
    for name, mart in marts.items():
        mart.write.mode("overwrite").parquet(f"{root}/marts/{name}")
    return {"stg_prices": stg, **{name: readers.read_layer(spark, f"{root}/marts/{name}") for name in marts}}


def mart_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """The six tests of the published tables."""
    stg, returns = tables["stg_prices"], tables["mart_daily_returns"]
    return union_sources(
        q.evaluate(stg, *q.not_null("ticker", "price_date", "close_price")),
        q.evaluate(returns, *q.not_null("ticker", "avg_daily_return_pct")),
        q.unique(returns, ["ticker"]),
    )


def refresh(feeds: dict[str, DataFrame], root: str, marts_from: str | None = None, order=("ingested_at",), rounding=half_up, max_rows: int | None = None) -> dict:
    """Full run over the given feeds; the marts are built from ``marts_from`` (default: the first).

    The cleaning statistics and the checks are returned as frames that run when they are read.
    """
    for source, bronze in feeds.items():
        refresh_source(bronze, source, root, order, rounding, max_rows)
    stats = union_sources(*[clean_stats(bronze, source, order) for source, bronze in feeds.items()])
    base = marts_from or next(iter(feeds))
    spark = next(iter(feeds.values())).sparkSession
    tables = refresh_marts(readers.read_silver(spark, root, base), root, rounding)
    return {"stats": stats, "tables": tables, "checks": mart_checks(tables)}
