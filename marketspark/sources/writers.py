"""Sinks. All files are Parquet with snappy, Spark's default, unless named otherwise; price layers are packed with zstd.

Yearly tables are shuffled with the ``rebalance`` hint rather than ``repartition("year")``: small
years end up in one file each, while adaptive execution splits a year that holds much of the data
over many tasks and files. Rows that come out of a shuffle by ticker are already dealt evenly; ``dealt`` writes them from
where they lie, one file per task and year, without a second shuffle.
"""

from pyspark.sql import DataFrame, DataFrameWriter

from ..operators.projections import with_year


def packed(df: DataFrame) -> DataFrameWriter:
    """A writer of a price layer, which takes three tenths less space so than with snappy."""
    return df.write.option("compression", "zstd")


def by_year(df: DataFrame, column: str = "date", dealt: bool = False) -> DataFrame:
    """The rows with their ``year``, in the order of a yearly table's files."""
    rows = with_year(df, column)
    return (rows if dealt else rows.hint("rebalance", "year")).sortWithinPartitions("year", "ticker", column)


def _write_by_year(df: DataFrame, path: str, dealt: bool = False) -> None:
    (
        packed(by_year(df, dealt=dealt)).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year")
        .parquet(path)
    )


def write_bronze_prices(df: DataFrame, path: str) -> None:
    """Bronze prices by year; only the years present are replaced."""
    _write_by_year(df, path)


def write_silver(df: DataFrame, path: str, dealt: bool = False) -> None:
    """Silver prices by year, ordered by ticker in each file so that one ticker's row groups can be
    skipped to; only the years present are replaced. ``dealt``: the rows come out of a shuffle by ticker."""
    _write_by_year(df, path, dealt)


def write_gold(df: DataFrame, path: str) -> None:
    """Indicators, replaced as a whole, by data source."""
    packed(df).mode("overwrite").partitionBy("data_source").parquet(path)


def write_run_dated(df: DataFrame, path: str, run_date: str) -> None:
    """One folder per run date. An empty frame still leaves a file with the schema."""
    df.write.mode("overwrite").parquet(f"{path}/date={run_date}")


def write_sentiment(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_documents(df: DataFrame, path: str) -> None:
    """Document collections, rebuilt as a whole."""
    df.write.mode("overwrite").partitionBy("collection").parquet(path)


def append_run(metrics: DataFrame, path: str) -> None:
    """One more row of the run history."""
    metrics.write.mode("append").parquet(path)


def write_csv_summary(df: DataFrame, path: str, order=()) -> None:
    """A summary (one row per ticker) as a single CSV file with a header."""
    one = df.repartition(1)
    (one.sortWithinPartitions(*order) if order else one).write.mode("overwrite").option("header", True).csv(path)


def materialize(df: DataFrame, name: str, kind: str = "view", bucket_by=(), buckets: int = 64, sort_by=(), path: str | None = None) -> DataFrame:
    """``view`` registers the plan under a name; ``table`` runs it and stores the rows, at ``path`` if one is given.

    With ``bucket_by`` the table is stored in ``buckets`` files by the hash of these columns, each in the order of ``sort_by``: windows,
    aggregates and joins by them read it without a shuffle and, with
    ``spark.sql.legacy.bucketedTableScan.outputOrdering``, without a sort. All rows of one key are in one file.
    """
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        if bucket_by:
            writer = df.repartition(buckets, *bucket_by).write.bucketBy(buckets, *bucket_by).sortBy(*(sort_by or bucket_by))
        else:
            writer = df.write
        if path is not None:
            writer = writer.option("path", path)
        writer.mode("overwrite").saveAsTable(name)
    else:
        raise ValueError(f"unknown kind: {kind}")
    return df.sparkSession.table(name)
