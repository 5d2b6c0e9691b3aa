from datetime import datetime

import pytest
from conftest import TINY, rows_of
from pyspark.sql import functions as F

from checks import fixtures as fx
from marketspark.operators import filters as fl
from marketspark.operators import indicators as ind
from marketspark.operators import projections as pj
from marketspark.operators import retrieval as rt
from marketspark.operators import sentiment as sm
from marketspark.operators import windows as wn
from marketspark.plans import clean

DAY = datetime(2024, 1, 2)


@pytest.fixture
def dirty(spark):
    rows = [
        # ticker, date, open, high, low, close, volume, ingested_at
        ("A", "2024-01-01", "10", "11", "9", "10", "100", 1),
        ("A", "2024-01-02", "10", "11", "9", "10.5", "100", 1),
        ("A", "2024-01-02", "10", "11", "9", "11", "100", 2),  # later copy wins
        ("A", "2024-01-03", "10", "9", "11", "10", "100", 1),  # high below low
        ("A", "2024-01-04", "10", "NaN", "11", "10", "100", 1),  # unknown high is fine
        ("A", "2024-01-05", "10", "11", "9", "0", "100", 1),  # zero close
        ("A", "2024-01-06", "10", "11", "9", "abc", "100", 1),  # unreadable close
        ("A", "2024-01-07", "10", "11", "9", "NaN", "100", 1),  # NaN close
        (None, "2024-01-08", "10", "11", "9", "10", "100", 1),  # no ticker
        ("A", "not a date", "10", "11", "9", "10", "100", 1),
        ("A", "2024-01-09", "10", "11", "9", "10", "-1", 1),  # rule: volume
        ("ABCDEFGHIJKLMNOP", "2024-01-10", "10", "11", "9", "10", "1", 1),  # rule: ticker of 16 letters
        ("A", "2024-01-11", "-5", "11", "9", "-1", "1", 1),  # negative close
        ("B", "2024-01-01", None, None, None, "Infinity", None, 1),
    ]
    return spark.createDataFrame(
        rows, "ticker string, date string, open string, high string, low string, close string, volume string, ingested_at int"
    )


def test_clean_prices(dirty):
    rows = rows_of(clean.clean_prices(dirty, "feed"), "ticker", "date")
    assert [(row["ticker"], row["date"].day, row["close"]) for row in rows] == [
        ("A", 1, 10.0), ("A", 2, 11.0), ("A", 4, 10.0), ("B", 1, float("inf")),
    ]
    first, second, third, other = rows
    assert first["daily_return"] is None and second["daily_return"] == 0.1
    assert second["price_range"] == 2.0 and second["range_pct"] == pytest.approx(18.1818)
    assert third["high"] is None and third["price_range"] is third["typical_price"] is None
    assert other["volume"] is None
    assert {row["data_source"] for row in rows} == {"feed"}
    assert all(row["silver_processed_at"] for row in rows)


def test_clean_stats_add_up(dirty):
    (stats,) = rows_of(clean.clean_stats(dirty, "feed"))
    assert stats == {
        "source": "feed", "input_rows": 14, "output_rows": 4, "dropped_nulls": 4, "dropped_zeros": 3,
        "dropped_ohlc": 1, "dropped_dupes": 1, "validation_errors": 2,
    }
    drops = [stats[name] for name in ("dropped_nulls", "dropped_zeros", "dropped_dupes", "validation_errors")]
    assert stats["input_rows"] - stats["output_rows"] == sum(drops)


def test_rejects_name_their_rules(dirty):
    found = {row["failed_rules"][0] for row in rows_of(clean.rejects(dirty))}
    assert found == {"volume_not_negative", "ticker_length"}


def test_missing_required_column(dirty):
    broken = dirty.drop("close")
    out = clean.clean_prices(broken, "feed")
    assert out.isEmpty()
    assert {"ticker", "date", "close", "daily_return", "range_pct", "data_source"} <= set(out.columns)
    (stats,) = rows_of(clean.clean_stats(broken, "feed"))
    assert stats["input_rows"] == 14
    assert sum(value for name, value in stats.items() if name not in ("source", "input_rows")) == 0


def test_missing_optional_columns(dirty):
    rows = rows_of(clean.clean_prices(dirty.drop("open", "high", "low", "volume"), "feed"))
    assert rows and all(row["high"] is None and row["typical_price"] is None for row in rows)


def test_empty_input(dirty):
    empty = dirty.limit(0)
    assert clean.clean_prices(empty, "feed").isEmpty()
    (stats,) = rows_of(clean.clean_stats(empty, "feed"))
    assert sum(value for name, value in stats.items() if name != "source") == 0


def test_idempotent(spark):
    once = clean.clean_prices(fx.raw_prices(spark, TINY), "feed", fx.ARRIVAL, audit=False)
    twice = clean.clean_prices(once, "feed", fx.ARRIVAL, audit=False).select(*once.columns)
    assert once.count() == twice.count() > 0
    assert once.exceptAll(twice).isEmpty()


def test_stats_agree_with_the_cleaned_rows(spark):
    raw = fx.raw_prices(spark, TINY)
    (stats,) = rows_of(clean.clean_stats(raw, "feed", fx.ARRIVAL))
    assert stats["output_rows"] == clean.clean_prices(raw, "feed", fx.ARRIVAL).count()
    assert stats["validation_errors"] == clean.rejects(raw, fx.ARRIVAL).count()
    keys = clean.clean_prices(raw, "feed", fx.ARRIVAL).groupBy("ticker", "date").count()
    assert keys.filter("count > 1").isEmpty()


def test_rules_split_rows_without_loss(spark):
    raw = fl.drop_null_keys(fx.raw_prices(spark, TINY))
    ok, bad = fl.apply_rules(raw)
    assert ok.count() + bad.count() == raw.count()
    assert bad.filter(F.size("failed_rules") == 0).isEmpty()


def test_column_names(spark):
    frame = spark.createDataFrame([(1, 2, 3)], [" Date ", "Vol", "Adj Close"])
    assert pj.normalise_columns(frame).columns == ["date", "volume", "adj_close"]
    assert pj.normalise_name("OpenInt") == "open_interest"


def test_cast_prices_is_strict(spark):
    bad = spark.createDataFrame([(DAY, "x", "1", "1", "1", "1")], "date timestamp_ntz, close string, high string, low string, volume string, typical_price string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        pj.cast_prices(bad).collect()


def test_staging_rounds_volume_half_even(spark):
    silver = spark.createDataFrame(
        [("A", DAY, 1.0, 1.0, 1.0, 1.00005, volume, None, 0.0, 1.0, 0.0, "feed") for volume in (2.5, 3.5)]
        + [("A", DAY, 1.0, 1.0, 1.0, 0.0, 1.0, None, 0.0, 1.0, 0.0, "feed"), (None, DAY, 1.0, 1.0, 1.0, 1.0, 1.0, None, 0.0, 1.0, 0.0, "feed")],
        "ticker string, date timestamp_ntz, open double, high double, low double, close double, volume double, "
        "daily_return double, price_range double, typical_price double, range_pct double, data_source string",
    )
    rows = rows_of(pj.stg_prices(silver), "volume")
    assert [row["volume"] for row in rows] == [2, 4]
    assert {row["close_price"] for row in rows} == {1.0001}


def test_many_copies_of_one_bar(spark):
    """A third of all rows are copies of one bar; each task passes on one of them at most."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), (F.col("id") % 100).cast("string"))).alias("ticker"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-02")).otherwise(F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"))).alias("date"),
        (F.col("id") + 1.0).alias("close"),
        F.col("id").alias("ingested_at"),
    )
    cleaned = clean.clean_prices(rows, "feed")
    hot = rows_of(cleaned.filter("ticker = 'HOT'"))
    assert [row["close"] for row in hot] == [5998.0]
    plan = clean.survivors(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    (stats,) = rows_of(clean.clean_stats(rows, "feed"))
    assert stats["input_rows"] - stats["dropped_dupes"] == stats["output_rows"] == cleaned.count()


def test_columns_of_the_caller_stay(spark, make_bars):
    """Columns with the names that the library works with go through unchanged."""
    names = ["_previous", "_place", "_p", "_shares", "_tokens", "_words", "_counts", "_unit", "_gain", "_loss", "_mean", "_aside", "_volume"]
    bars = make_bars({"A": [1.0, 2.0, 4.0], "B": [3.0, 3.0]}).withColumns({name: F.concat(F.lit(name), "ticker") for name in names})
    texts = bars.withColumn("text", F.lit("profit rises"))
    for found in (
        wn.daily_return(bars), wn.dedup_last(bars, ("ticker", "date"), ("volume",)), wn.latest_n(bars, 5), ind.rsi(bars),
        ind.bollinger(bars), sm.score_sentiment(texts, "text"), rt.embed(texts),
    ):
        assert found.select(*bars.columns).exceptAll(bars).isEmpty() and found.count() == 5
        plain = found.select([column for column in found.columns if column not in bars.columns])
        assert not [column for column in plain.columns if column.startswith("_")]
    assert ind.rsi(bars).drop(*names).exceptAll(ind.rsi(bars.drop(*names))).isEmpty()


def test_cleaning_shuffles_rows_once(spark, make_bars, monkeypatch):
    """Copies and returns share the shuffle by ticker; of a crowded ticker only last copies enter it, with the same result."""
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    raw = make_bars({"A": [float(n + 1) for n in range(40)], "B": [3.0, 4.0, 2.0]})
    copies = raw.withColumn("ingested_at", F.lit(1)).unionByName(
        raw.filter("ticker = 'A'").withColumns({"close": F.col("close") + 0.5, "ingested_at": F.lit(2)})
    )
    cleaned = clean.clean_prices(copies, "feed", audit=False)
    by_ticker = [line for line in plan(cleaned).splitlines() if "Exchange hashpartitioning(ticker" in line and "REPARTITION_BY_COL" in line]
    assert len(by_ticker) == 1 and "WindowGroupLimit" in plan(cleaned)
    # Above the repartition neither copies nor returns need another exchange.
    assert "Exchange" not in plan(cleaned).split("REPARTITION_BY_COL")[0].rsplit("Exchange hashpartitioning(ticker", 1)[0]
    plain = rows_of(cleaned, "ticker", "date")
    assert [row["close"] for row in plain][:2] == [1.5, 2.5] and len(plain) == 43
    monkeypatch.setattr(clean, "CROWDED", 10)
    assert rows_of(clean.clean_prices(copies, "feed", audit=False), "ticker", "date") == plain
    assert rows_of(clean.clean_prices(copies, "feed", audit=False, max_rows=5), "ticker", "date") == plain
