"""Ranks, top lists and ordered reads, none of which sorts a whole dataset in one task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.numeric import half_up
from .filters import for_ticker, has_title
from .ranges import ranged


def _ties(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("_ties"))


def _real(column: str):
    return F.col(column).isNotNull() & ~F.isnan(F.col(column))


def rank_movers(df: DataFrame, column: str = "daily_return", rows: int = 1 << 20) -> DataFrame:
    """``gainer_rank`` and ``loser_rank`` of every row that has a return: global ranks, ties share one. NaN is no
    return, as null.

    Rows are dealt to ranges of about ``rows`` by value and ranked inside them; the rows of the ranges before or behind are
    added. A value that goes over the border of a range has the rank of its first row, which the counts of
    the values at the borders tell. Runs jobs; one summary row per range reaches the driver.
    """
    dealt = ranged(df.filter(_real(column)), [column], rows)
    value = F.col(column)
    edges = dealt.groupBy("_part").agg(F.min(column).alias("_low"), F.max(column).alias("_high"), F.count(F.lit(1)).alias("_rows"))
    at_edges = dealt.join(edges, "_part").groupBy("_part", "_low", "_high", "_rows").agg(
        F.count_if(value == F.col("_low")).alias("_at_low"), F.count_if(value == F.col("_high")).alias("_at_high")
    )
    found = sorted(at_edges.collect(), key=lambda row: row["_part"])
    smaller, larger = _outside(found, "_high", "_low", "_at_high"), _outside(found[::-1], "_low", "_high", "_at_low")
    schema = "_part bigint, _low double, _high double, _below bigint, _below_low bigint, _above bigint, _above_high bigint"
    places = [(row["_part"], row["_low"], row["_high"], *smaller[row["_part"]], *larger[row["_part"]]) for row in found]
    outside = df.sparkSession.createDataFrame([(part, float(low), float(high), *rest) for part, low, high, *rest in places], schema)
    inside = Window.partitionBy("_part")
    rank_up = F.col("_below") + F.rank().over(inside.orderBy(value.asc()))
    rank_down = F.col("_above") + F.rank().over(inside.orderBy(value.desc()))
    return dealt.join(outside, "_part").select(
        *df.columns,
        F.when(value == F.col("_high"), F.col("_above_high") + 1).otherwise(rank_down).alias("gainer_rank"),
        F.when(value == F.col("_low"), F.col("_below_low") + 1).otherwise(rank_up).alias("loser_rank"),
    )


def _outside(ranges, far: str, near: str, at_far: str) -> dict:
    """For each range, in order: the rows of the ranges passed, and those of them that are not equal to its nearest value."""
    passed, equal, last, found = 0, 0, None, {}
    for row in ranges:
        same = equal if last is not None and last == row[near] else 0
        found[row["_part"]] = (passed, passed - same)
        # A range of one value only prolongs the run of it.
        whole = row["_low"] == row["_high"]
        equal = (same if whole else 0) + row[at_far]
        passed, last = passed + row["_rows"], row[far]
    return found


def keep_movers(df: DataFrame, k: int = 10, column: str = "daily_return") -> DataFrame:
    """Rows among the k best or k worst by rank, ties kept, with both ranks.

    Only the k largest and k smallest distinct values can rank within k, so the ordering works on at
    most 2k counted values, and those (never more) are what is broadcast back to the rows.
    """
    values = _ties(df.filter(_real(column)), column)
    total = values.agg(F.sum("_ties")).scalar()

    def edge(order, rank, other):
        ahead = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        place = F.coalesce(F.sum("_ties").over(ahead), F.lit(0)) + 1
        return (
            values.orderBy(order).limit(k)
            .withColumn(rank, place)
            .filter(F.col(rank) <= k)
            .withColumn(other, total - F.col(rank) - F.col("_ties") + 2)
            .select(column, "gainer_rank", "loser_rank")
        )

    best = edge(F.col(column).desc(), "gainer_rank", "loser_rank")
    worst = edge(F.col(column).asc(), "loser_rank", "gainer_rank")
    edges = best.unionByName(worst).dropDuplicates([column])
    return df.join(F.broadcast(edges), column)


def top_performers(stats: DataFrame, limit: int | None = 10) -> DataFrame:
    ranked = stats.orderBy(F.col("avg_daily_return_pct").desc_nulls_last(), "ticker")
    return ranked if limit is None else ranked.limit(limit)


def top_articles(news: DataFrame, ticker: str | None = None, limit: int | None = 10, tie: str = "url", rounding=half_up) -> DataFrame:
    """Most confident articles first."""
    if ticker is not None:
        news = for_ticker(news, ticker)
    keys = ["published_at", "title"] + ([tie] if tie in news.columns else [])
    ranked = news.orderBy(
        F.col("sentiment_score").desc_nulls_last(), *[F.col(key).asc_nulls_last() for key in keys]
    )
    if limit is not None:
        ranked = ranked.limit(limit)
    return ranked.select(
        "ticker", "title", "sentiment", rounding(F.col("sentiment_score"), 4).alias("confidence"), "source", "published_at"
    )


def last_n_ascending(df: DataFrame, ticker: str, n: int = 252, order: str = "date") -> DataFrame:
    """The n most recent rows of one ticker, oldest first."""
    recent = for_ticker(df, ticker).orderBy(F.col(order).desc_nulls_last()).limit(n)
    return recent.orderBy(order)


def first_n_docs(df: DataFrame, n: int = fv.NEWS_DOCUMENTS, keys=("ticker", "url")) -> DataFrame:
    """n titled rows by key order: the same ones on every run."""
    return has_title(df).orderBy(*keys).limit(n)


def sample_rows(df: DataFrame, n: int, keys, seed: int = 0) -> DataFrame:
    """Exactly n rows (or all), chosen by the MD5 of their key and the seed: the same ones on every run."""
    chosen = F.md5(F.concat_ws("|", *[F.col(key).cast("string") for key in keys], F.lit(str(seed))))
    return df.orderBy(chosen, *keys).limit(n)


def run_history(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.col("start_time").desc(), "run_id")
