"""The library's input datasets, derived from the given tables (whole tables, no subsets)."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.functions.numeric import stable
from marketspark.plans.clean import enrich

#: Arrival order of raw prices for "last wins".
ARRIVAL = ("a1", "a2", "a3", "close", "volume", "open", "high", "low")

#: Words of the invented headlines that stand in for good and bad news.
GOOD_WORDS = ("the", "that", "with", "le", "der")
BAD_WORDS = ("of", "and", "un", "die")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ticker(column) -> Column:
    return F.concat(F.lit("T"), F.col(column).cast("string"))


def bars(spark, sf_dir) -> DataFrame:
    """One clean daily bar per supplier and ship date."""
    price = F.col("l_extendedprice")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", "l_shipdate")
        .agg(
            F.max(price).alias("close"),
            F.min(price).alias("open"),
            F.max(price * (1.0 + F.col("l_tax"))).alias("high"),
            F.min(price * (1.0 - F.col("l_discount"))).alias("low"),
            F.sum("l_quantity").alias("volume"),
        )
        .select(_ticker("l_suppkey").alias("ticker"), F.col("l_shipdate").alias("date"), "open", "high", "low", "close", "volume")
    )


def silver(spark, sf_dir) -> DataFrame:
    return enrich(bars(spark, sf_dir)).withColumn("data_source", F.lit("feed"))


def raw_prices(spark, sf_dir) -> DataFrame:
    """Dirty bars: null tickers and closes, zero closes, high below low, bad volumes, copies."""
    key, price = F.col("l_orderkey"), F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.when(key % 73 != 0, _ticker("l_suppkey")).alias("ticker"),
        F.col("l_shipdate").alias("date"),
        price.alias("open"),
        F.when(key % 83 == 0, price * 0.5).otherwise(price * (1.0 + F.col("l_tax"))).alias("high"),
        (price * (1.0 - F.col("l_discount"))).alias("low"),
        F.when(key % 97 == 0, None).when(key % 89 == 0, 0.0).otherwise(price).alias("close"),
        F.when(key % 79 == 0, None).when(key % 71 == 0, -1.0).otherwise(F.col("l_quantity")).alias("volume"),
        key.alias("a1"),
        F.col("l_linenumber").alias("a2"),
        F.col("l_partkey").alias("a3"),
    )


def scored_news(spark, sf_dir) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    return table(spark, sf_dir, "events").select(
        _ticker("user_id").alias("ticker"),
        F.col("props").alias("title"),
        kind.alias("source"),
        F.when(kind.isin("purchase", "signup"), "positive").when(kind == "error", "negative").otherwise("neutral").alias("sentiment"),
        stable(0.34 + 0.66 * value / (value + 100.0), 4).alias("sentiment_score"),
        F.col("ts").alias("published_at"),
        F.concat(F.lit("event/"), F.col("event_id").cast("string")).alias("url"),
    )


def headlines(spark, sf_dir) -> DataFrame:
    """Whole documents as headlines, some of them blank."""
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("T"), (doc % 50).cast("string")).alias("ticker"),
        F.when(doc % 41 == 0, "").when(doc % 43 != 0, F.col("text")).alias("title"),
        F.col("lang").alias("description"),
        F.concat(F.lit("doc/"), doc.cast("string")).alias("url"),
        "source",
        doc.cast("string").alias("published_at"),
    )


def filings(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    key = F.col("o_orderkey").cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        _ticker("o_custkey").alias("ticker"),
        F.when(F.col("o_orderstatus") == "F", "10-K").otherwise("10-Q").alias("form_type"),
        F.col("c_name").alias("entity_name"),
        F.concat(F.substring(day, 1, 7), F.lit("-01")).alias("period_of_report"),
        day.alias("file_date"),
        F.concat_ws(
            "-",
            F.lpad(F.col("o_custkey").cast("string"), 10, "0"),
            F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0"),
            F.lpad(key, 8, "0"),
        ).alias("accession_no"),
    )


def news_payloads(spark, sf_dir) -> DataFrame:
    """Search responses: one per document, its text as article title, with gaps; some have failed."""
    doc = F.col("doc_id")
    article = F.struct(
        F.when(doc % 11 != 0, F.col("text")).alias("title"),
        F.when(doc % 7 != 0, F.col("lang")).alias("description"),
        F.concat(F.lit("doc/"), doc.cast("string")).alias("url"),
        F.when(doc % 5 != 0, F.struct(F.col("source").alias("name"))).alias("source"),
        doc.cast("string").alias("publishedAt"),
        F.lit(None).cast("string").alias("content"),
    )
    short = F.struct(
        F.col("lang").alias("title"),
        F.lit(None).cast("string").alias("description"),
        F.concat(F.lit("short/"), doc.cast("string")).alias("url"),
        F.struct(F.lit(None).cast("string").alias("name")).alias("source"),
        doc.cast("string").alias("publishedAt"),
        F.col("source").alias("content"),
    )
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("T"), (doc % 50).cast("string")).alias("ticker"),
        F.when(doc % 13 == 0, "error").otherwise("ok").alias("status"),
        F.when(doc % 2 == 0, F.array(article, short)).otherwise(F.array(article)).alias("articles"),
    )


def filings_payloads(spark, sf_dir) -> DataFrame:
    """Filing searches: one per order with none to eight hits, some without a form type."""
    key = F.col("o_orderkey")

    def hit(place):
        source = F.struct(
            F.when(place % 3 != 0, "10-K").alias("form_type"),
            F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("entity_name"),
            F.when(place % 4 != 1, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("period_of_report"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("file_date"),
            F.concat_ws("-", F.lpad(key.cast("string"), 10, "0"), F.lit("00"), place.cast("string")).alias("accession_no"),
        )
        return F.struct(source.alias("_source"))

    numbers = F.when(key % 9 == 0, F.array().cast("array<bigint>")).otherwise(F.sequence(F.lit(1).cast("bigint"), key % 9))
    return table(spark, sf_dir, "orders").select(
        _ticker("o_custkey").alias("ticker"),
        F.when(F.col("o_orderstatus") == "F", "10-K").otherwise("10-Q").alias("form"),
        F.when(key % 17 == 0, 500).otherwise(200).cast("bigint").alias("status"),
        F.struct(F.transform(numbers, hit).alias("hits")).alias("hits"),
    )


#: The letters and digits that the plain embedder counts.
LETTERS = "aein0123456789"


def letter_embedding(text: Column) -> Column:
    """Shares of some letters and of the digits: a vector that any SQL engine can compute too."""
    plain = F.lower(text)
    counts = [F.length(plain) - F.length(F.replace(plain, F.lit(letter), F.lit(""))) for letter in LETTERS]
    total = F.length(plain) - F.length(F.translate(plain, "abcdefghijklmnopqrstuvwxyz0123456789", ""))
    return F.array(*[F.coalesce(F.try_divide(count.cast("double"), total), F.lit(0.0)) for count in counts])


def questions(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))
