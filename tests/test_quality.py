from datetime import date

import pytest
from conftest import TINY, rows_of
from pyspark.sql import functions as F

from marketspark import fixed_values as fv
from marketspark.operators import aggregates as ag
from marketspark.operators import quality as q
from marketspark.operators.combine import union_sources


@pytest.fixture
def prices(spark):
    rows = [("KMI", date(2019, 1, 2), 1.0), ("KMI", date(2020, 1, 2), 0.0), ("PXD", date(2099, 1, 2), None), (None, None, 2.0)]
    return spark.createDataFrame(rows, "ticker string, date date, close double")


def status_of(checks):
    return {row["check"]: (row["status"], row["value"]) for row in rows_of(checks)}


def test_checks_in_one_pass(prices):
    checks = q.evaluate(
        prices, *q.not_null("ticker", "close"), q.min_rows(4), q.positive("close"), q.starts_in_year("date", 2019),
        q.key_count("ticker", 2), q.no_future("date"), q.has_values("ticker", ("KMI", "XOM")),
        *q.universe_check(4, ("KMI",), ("PXD",)),
    )
    assert status_of(checks) == {
        "not_null_ticker": ("failed", "1"), "not_null_close": ("failed", "1"), "min_rows": ("passed", "4"),
        "positive_close": ("failed", "2"), "date_starts_in_year": ("passed", "2019-01-02"),
        "ticker_count": ("passed", "2"), "date_not_in_future": ("failed", "1"), "ticker_has_values": ("failed", "1"),
        "universe_size": ("passed", "4"), "universe_has_KMI": ("passed", "2"), "universe_without_PXD": ("failed", "1"),
    }
    assert {row["status"]: row["checks"] for row in rows_of(q.tally(checks))} == {"passed": 5, "failed": 6}


def test_checks_on_no_rows(prices):
    found = status_of(q.evaluate(prices.limit(0), *q.not_null("ticker"), q.min_rows(1), q.starts_in_year("date", 2019), q.share_check("ticker", 0.5)))
    assert found == {
        "not_null_ticker": ("passed", "0"), "min_rows": ("failed", "0"), "date_starts_in_year": ("failed", None),
        "ticker_present_pct": ("warned", "0.0"),
    }


def test_unique_and_summary(prices):
    assert status_of(q.unique(prices, ["ticker"])) == {"unique_ticker": ("failed", "1")}
    assert status_of(q.unique(prices, ["ticker", "date"])) == {"unique_ticker_date": ("passed", "0")}
    assert rows_of(ag.duplicates(prices, ["ticker"])) == [{"ticker": "KMI", "n_records": 2}]
    (summary,) = rows_of(q.test_summary(ag.duplicates(prices, ["ticker"])))
    assert summary == {"failures": 1, "should_warn": True, "should_error": True}


def test_share(spark):
    news = spark.createDataFrame([("a",), ("",), (None,), ("b",)], "title string")
    assert rows_of(ag.share_non_empty(news)) == [{"total": 4, "empty": 2, "pct_ok": 50.0}]
    assert status_of(q.evaluate(news, q.share_check("title", 0.5))) == {"title_present_pct": ("passed", "50.0")}
    assert status_of(q.evaluate(news, q.share_check("title", 0.9))) == {"title_present_pct": ("warned", "50.0")}


def test_health(spark):
    found = {row["dataset"]: row for row in rows_of(q.dataset_health(spark, {"region": f"{TINY}/region.parquet", "gone": f"{TINY}/gone"}))}
    assert found["region"]["rows"] == 5 and found["region"]["error"] is None
    assert found["gone"]["rows"] is None and found["gone"]["error"] == "PATH_NOT_FOUND"
    assert {row["status"] for row in found.values()} == {"healthy"}


def test_health_opens_no_readable_file_again(spark, tmp_path):
    """A file longer than Spark may read whole is fine as long as its rows can be read; odd names of broken ones are found."""
    spark.range(5000).coalesce(1).write.parquet(str(tmp_path / "a b" / "good"))
    for name in ("a b/broken {1}.parquet", "50%25+[x].parquet"):
        (tmp_path / name).write_text("no table")
    (tmp_path / "empty.parquet").touch()
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        broken = {row["path"].rsplit("/", 1)[1]: row["bytes"] for row in rows_of(q.unreadable_files(spark, str(tmp_path)))}
        (health,) = rows_of(q.dataset_health(spark, {"all": str(tmp_path)}))
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert broken == {"broken {1}.parquet": 8, "50%25+[x].parquet": 8, "empty.parquet": 0}
    assert health["rows"] == 5000 and health["error"] == "UNREADABLE_FILES: 3"


def test_universe_values(spark):
    tickers = spark.createDataFrame([(name,) for name in fv.TICKERS], "ticker string")
    assert {row["status"] for row in rows_of(q.evaluate(tickers, *q.universe_check()))} == {"passed"}
    assert len(set(fv.TICKERS)) == fv.UNIVERSE_SIZE


def test_counts_and_spans(prices):
    assert rows_of(ag.dataset_counts(prices, "ticker")) == [{"rows": 4, "keys": 2}]
    assert rows_of(ag.dataset_counts(prices, "ticker", approximate=True)) == [{"rows": 4, "keys": 2}]
    assert rows_of(ag.date_span(prices)) == [{"min_date": date(2019, 1, 2), "max_date": date(2099, 1, 2)}]
    years = {row["year"]: row["rows"] for row in rows_of(ag.rows_by_year(prices))}
    assert years == {2019: 1, 2020: 1, 2099: 1, None: 1}


def test_coverage(spark, prices):
    universe = spark.createDataFrame([("KMI",), ("XOM",), ("XOM",)], "ticker string")
    found = {row["ticker"]: row for row in rows_of(ag.coverage(prices, universe))}
    assert set(found) == {"KMI", "XOM"}
    assert (found["KMI"]["status"], found["KMI"]["rows"]) == ("succeeded", 2)
    assert (found["XOM"]["status"], found["XOM"]["rows"], found["XOM"]["first_date"]) == ("failed", 0, None)


def test_union_fills_missing_columns(prices):
    out = union_sources(prices, prices.select("ticker").withColumn("extra", F.lit(1)))
    assert out.count() == 8 and out.filter("extra = 1 and close is null").count() == 4
