"""Unions and the latest-date restriction."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_date(df: DataFrame, column: str = "price_date") -> DataFrame:
    """One row, one column: the latest date."""
    return df.agg(F.max(column).alias("max_date"))


def at_latest_date(df: DataFrame, column: str = "price_date") -> DataFrame:
    """Rows of the latest date, which is a scalar subquery: no join, no driver round trip."""
    return df.filter(F.col(column) == latest_date(df, column).scalar())


def latest_partition(df: DataFrame, column: str = "year") -> DataFrame:
    """Rows of the last partition. Finding it opens every file but reads no column; the rows come from one folder."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def union_sources(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; a column that a frame lacks is null in its rows."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
