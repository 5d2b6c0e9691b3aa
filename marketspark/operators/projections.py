"""Projections: casts, renames, audit columns, read models."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import text as tx
from ..functions.numeric import half_up, to_number, to_whole


def unused(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as it takes to be none of the frame's columns."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def normalise_name(name: str, aliases=None) -> str:
    plain = re.sub(r"\s", "_", name.strip().lower())
    return (fv.HEADER_ALIASES if aliases is None else aliases).get(plain, plain)


def normalised(name: Column) -> Column:
    """The same for headers that are values of a column."""
    plain = F.regexp_replace(F.lower(F.trim(name)), r"\s", "_")
    aliases = F.create_map(*[F.lit(part) for pair in fv.HEADER_ALIASES.items() for part in pair])
    return F.coalesce(F.try_element_at(aliases, plain), plain)


def normalise_columns(df: DataFrame, aliases=None) -> DataFrame:
    """Trimmed lower-case headers with blanks as underscores and known aliases resolved."""
    return df.toDF(*[normalise_name(name, aliases) for name in df.columns])


def normalise_prices(df: DataFrame, source: str, ticker: Column | None = None) -> DataFrame:
    """Landed price feed to bronze rows: canonical column order, only the columns that exist."""
    df = normalise_columns(df)
    added = {"source": F.lit(source), "ingested_at": F.current_timestamp()}
    if ticker is not None:
        added["ticker"] = ticker
    df = df.withColumns(added)
    if "date" in df.columns:
        df = df.withColumn("date", to_instant(df, "date"))
    return df.select(*[name for name in fv.PRICE_COLUMNS if name in df.columns])


def to_instant(df: DataFrame, column: str) -> Column:
    """Timestamp without zone; text that is not a date becomes null."""
    if dict(df.dtypes)[column].startswith("timestamp"):
        return F.col(column)
    return F.col(column).try_cast("timestamp_ntz")


def safe_cast(df: DataFrame, dates=("date",), numbers=("open", "high", "low", "close", "volume")) -> DataFrame:
    """Casts that turn bad values into null; a missing number column becomes a null column."""
    casts = {name: to_instant(df, name) for name in dates}
    for name in numbers:
        casts[name] = to_number(name) if name in df.columns else F.lit(None).cast("double")
    return df.withColumns(casts)


def cast_prices(df: DataFrame) -> DataFrame:
    """Strict casts: a value that is not a number is an error, not a null."""
    casts = {name: F.col(name).cast("double") for name in ("close", "high", "low", "volume", "typical_price")}
    if not dict(df.dtypes)["date"].startswith("timestamp"):
        casts["date"] = F.col("date").cast("timestamp")
    return df.withColumns(casts)


def with_audit(df: DataFrame, **columns) -> DataFrame:
    """Lineage columns: ``with_audit(df, data_source="feed", processed_at=None)``; None means now."""
    return df.withColumns(
        {name: F.current_timestamp() if value is None else F.lit(value) for name, value in columns.items()}
    )


def _stamp():
    """The time of the run as ISO text, as landed rows carry it."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def landed_news(articles: DataFrame, run_date: str) -> DataFrame:
    """Articles with the time and the date of the run that landed them."""
    return articles.withColumns({"ingested_at": _stamp(), "ingestion_date": F.lit(run_date)})


def landed_filings(hits: DataFrame) -> DataFrame:
    """Filings with their source and the time at which they were landed."""
    return hits.withColumns({"source": F.lit(fv.FILINGS_SOURCE), "ingested_at": _stamp()})


def with_year(df: DataFrame, column: str = "date") -> DataFrame:
    return df.withColumn("year", F.year(column))


def stg_prices(df: DataFrame, rounding=half_up) -> DataFrame:
    """Typed and rounded staging rows with a positive close, a date and a ticker."""
    places = {
        "open_price": ("open", 4),
        "high_price": ("high", 4),
        "low_price": ("low", 4),
        "close_price": ("close", 4),
        "daily_return": ("daily_return", 6),
        "price_range": ("price_range", 4),
        "typical_price": ("typical_price", 4),
        "range_pct": ("range_pct", 4),
    }
    number = {name: rounding(F.col(source).cast("double"), n).alias(name) for name, (source, n) in places.items()}
    return df.filter((F.col("close").cast("double") > 0) & F.col("date").isNotNull() & F.col("ticker").isNotNull()).select(
        F.col("date").cast("date").alias("price_date"),
        "ticker",
        number["open_price"],
        number["high_price"],
        number["low_price"],
        number["close_price"],
        to_whole(F.col("volume")).alias("volume"),
        number["daily_return"],
        number["price_range"],
        number["typical_price"],
        number["range_pct"],
        "data_source",
    )


def indicator_view(df: DataFrame, rounding=half_up) -> DataFrame:
    """Read model: prices and bands to 2 places, MACD and bandwidth to 4."""
    places = {
        "close": 2, "rsi_14": 2,
        "macd_line": 4, "macd_signal": 4, "macd_histogram": 4,
        "bb_upper": 2, "bb_middle": 2, "bb_lower": 2, "bb_bandwidth": 4,
        "vwap": 2, "sma_50": 2, "sma_200": 2,
    }
    shown = {name: rounding(F.col(name), n).alias(name) for name, n in places.items()}
    labels_after = {"vwap": "vwap_signal", "sma_200": "ma_signal"}
    columns = [F.col("date").cast("date").alias("date"), F.col("ticker")]
    for name, column in shown.items():
        columns.append(column)
        if name in labels_after:
            columns.append(F.col(labels_after[name]))
    return df.select(*columns)


def upper_ticker(df: DataFrame) -> DataFrame:
    return df.withColumn("ticker", F.upper("ticker"))


def blank_nulls(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({name: tx.or_blank(name) for name in columns})


def with_meta(df: DataFrame, columns: dict, name: str = "meta") -> DataFrame:
    """One struct column; ``columns`` maps field names to columns."""
    return df.withColumn(name, F.struct(*[column.alias(field) for field, column in columns.items()]))


def with_doc_id(df: DataFrame, prefix: str, keys, digest: bool = False, name: str = "id") -> DataFrame:
    """Id from the row's own key, so it stays the same on any partitioning and any rerun."""
    key = F.concat_ws("|", *[F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys])
    return df.withColumn(name, F.concat(F.lit(prefix + "_"), F.sha2(key, 256) if digest else key))


def display_names(df: DataFrame, report: str) -> DataFrame:
    headings = fv.HEADINGS[report]
    return df.select(*[F.col(name).alias(heading) for name, heading in headings.items()])
