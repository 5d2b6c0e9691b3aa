"""Grouped statistics. All of them aggregate partially before they shuffle."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.numeric import half_up, safe_div
from .filters import has_return


def _rows() -> Column:
    return F.count(F.lit(1))


def _count_of(label: str, column: str = "sentiment") -> Column:
    return F.count_if(F.col(column) == label)


def daily_return_stats(stg: DataFrame, rounding=half_up) -> DataFrame:
    """Return, price and volume statistics per ticker over the bars that have a return."""
    ret, close = F.col("daily_return"), F.col("close_price")
    mean, spread = F.avg(ret), F.stddev_samp(ret)
    percent = {
        "avg_daily_return_pct": mean,
        "volatility_pct": spread,
        "best_day_pct": F.max(ret),
        "worst_day_pct": F.min(ret),
    }
    price = {"avg_close": F.avg(close), "max_close": F.max(close), "min_close": F.min(close)}
    return has_return(stg).groupBy("ticker").agg(
        _rows().alias("trading_days"),
        *[rounding(value * 100, 4).alias(name) for name, value in percent.items()],
        *[rounding(value, 2).alias(name) for name, value in price.items()],
        rounding(F.avg("volume"), 0).alias("avg_volume"),
        F.min("price_date").alias("first_date"),
        F.max("price_date").alias("last_date"),
        # No spread (one bar, or a constant return) means no ratio: 0.
        rounding(F.coalesce(safe_div(mean, spread), F.lit(0.0)), 4).alias("return_risk_ratio"),
    )


def sentiment_summary(news: DataFrame, by=("ticker",), rounding=half_up) -> DataFrame:
    return news.groupBy(*by).agg(
        _rows().alias("total_articles"),
        _count_of("positive").alias("bullish"),
        _count_of("negative").alias("bearish"),
        _count_of("neutral").alias("neutral"),
        rounding(F.avg("sentiment_score"), 4).alias("avg_confidence"),
    )


def sentiment_by_ticker(news: DataFrame, rounding=half_up) -> DataFrame:
    """Label counts per ticker, most positive articles first."""
    counts = news.groupBy("ticker").agg(
        _rows().alias("total"),
        *[_count_of(label).alias(label) for label in fv.SENTIMENT_LABELS],
        rounding(F.avg("sentiment_score"), 4).alias("avg_confidence"),
    )
    return counts.orderBy(F.col("positive").desc(), "ticker")


def label_distribution(news: DataFrame, by=(), label: str = "sentiment", rounding=half_up) -> DataFrame:
    """Rows per label and their share of the total (of the group, with ``by``)."""
    counts = news.groupBy(*by, label).agg(_rows().alias("count"))
    # The window runs over the counts, one row per label, not over the articles.
    total = F.sum("count").over(Window.partitionBy(*by))
    return counts.withColumn("pct", rounding(F.col("count") * 100.0 / total, 1))


def dataset_counts(df: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct(key) if approximate else F.count_distinct(F.col(key))
    return df.agg(_rows().alias("rows"), distinct.alias("keys"))


def date_span(df: DataFrame, column: str = "date") -> DataFrame:
    return df.agg(F.min(column).cast("date").alias("min_date"), F.max(column).cast("date").alias("max_date"))


def share_non_empty(df: DataFrame, column: str = "title", rounding=half_up) -> DataFrame:
    """Total rows, empty rows and the percentage that is not empty."""
    total, empty = _rows(), F.count_if(F.coalesce(F.col(column), F.lit("")) == "")
    return df.agg(
        total.alias("total"),
        empty.alias("empty"),
        rounding((total - empty) * 100.0 / F.greatest(total, F.lit(1)), 1).alias("pct_ok"),
    )


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(_rows().alias("n"))


def duplicates(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once; a null is no key."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(_rows().alias("n_records")).filter("n_records > 1")


def confidence_quantiles(news: DataFrame, by=("sentiment",), score: str = "sentiment_score") -> DataFrame:
    """Box-plot figures per label, to 6 places.

    Exact percentiles keep a count per distinct value, and 4-place scores have at most 10,001.
    """
    five = F.percentile(F.round(F.col(score), 4), F.array(*[F.lit(q) for q in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    names = ("minimum", "q1", "median", "q3", "maximum")
    return news.groupBy(*by).agg(_rows().alias("count"), five.alias("_five")).select(
        *by, "count", *[F.round(F.get("_five", F.lit(place)), 6).alias(name) for place, name in enumerate(names)]
    )


def run_metrics(news: DataFrame, elapsed_seconds: float, params: dict | None = None, rounding=half_up) -> DataFrame:
    """One row per scoring run: totals, label counts and shares, speed; ``params`` as extra columns."""
    total = _rows()
    per_label = []
    for label in fv.SENTIMENT_LABELS:
        count = _count_of(label)
        per_label.append(count.alias(f"{label}_count"))
        per_label.append(rounding(count * 100.0 / F.greatest(total, F.lit(1)), 2).alias(f"{label}_pct"))
    metrics = news.agg(
        total.alias("total_headlines"),
        rounding(total / F.lit(max(float(elapsed_seconds), 1.0)), 2).alias("headlines_per_second"),
        F.lit(round(float(elapsed_seconds), 1)).alias("elapsed_seconds"),
        *per_label,
    )
    return metrics.withColumns({name: F.lit(str(value)) for name, value in (params or {}).items()})


def rows_by_year(df: DataFrame, column: str = "date") -> DataFrame:
    return df.groupBy(F.year(column).cast("bigint").alias("year")).agg(_rows().alias("rows"))


def coverage(df: DataFrame, universe: DataFrame, column: str = "date") -> DataFrame:
    """Every ticker of the universe: succeeded with its row count and dates, or failed with none."""
    present = df.groupBy("ticker").agg(
        _rows().alias("rows"), F.min(column).alias("first_date"), F.max(column).alias("last_date")
    )
    wanted = universe.select("ticker").distinct()
    found = F.col("rows").isNotNull()
    return wanted.join(present, "ticker", "left").select(
        "ticker",
        F.coalesce(F.col("rows"), F.lit(0)).alias("rows"),
        "first_date",
        "last_date",
        F.when(found, "succeeded").otherwise("failed").alias("status"),
    )
