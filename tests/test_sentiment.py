import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from marketspark.operators import aggregates as ag
from marketspark.operators import ranking as rk
from marketspark.operators import sentiment as sm
from marketspark.operators import windows as wn
from marketspark.plans import reports


def fixed(positive, negative, neutral):
    return lambda text: F.struct(F.lit(positive).alias("positive"), F.lit(negative).alias("negative"), F.lit(neutral).alias("neutral"))


@pytest.fixture
def titles(spark):
    return spark.createDataFrame(
        [(1, "Profits SURGE, record growth"), (2, "Shares fall on lawsuit fear"), (3, "Board meets"), (4, ""), (5, None), (6, "gain and loss")],
        "id int, title string",
    )


def test_word_list_labels(titles):
    rows = {row["id"]: row for row in rows_of(sm.score_sentiment(titles))}
    assert [rows[n]["sentiment"] for n in range(1, 7)] == ["positive", "negative", "neutral", "neutral", "neutral", "positive"]
    assert rows[3]["prob_positive"] == 0.2119 and rows[3]["sentiment_score"] == 0.5761
    for row in rows.values():
        assert row["prob_positive"] + row["prob_negative"] + row["prob_neutral"] == pytest.approx(1, abs=2e-4)
    assert len(rows) == 6  # scoring keeps every row


@pytest.mark.parametrize("shares,label", [((0.4, 0.4, 0.2), "positive"), ((0.2, 0.4, 0.4), "negative"), ((0.3, 0.3, 0.4), "neutral")])
def test_ties_go_to_the_first_label(titles, shares, label):
    rows = rows_of(sm.score_sentiment(titles, scorer=fixed(*shares)))
    assert {row["sentiment"] for row in rows} == {label}
    assert {row["sentiment_score"] for row in rows} == {max(shares)}


def test_long_texts_are_scored_whole(spark):
    text = "filler " * 5000 + "surge " * 900
    (row,) = rows_of(sm.score_sentiment(spark.createDataFrame([(text,)], "title string")))
    assert row["sentiment"] == "positive" and row["sentiment_score"] == 1.0


def test_model_scorer_batches(titles):
    def load():
        def predict(texts):
            assert 0 < len(texts) <= 2
            return [[0.1, 0.2, 0.7] if not text else [0.5, 0.25, 0.25] for text in texts]

        return predict

    rows = {row["id"]: row["sentiment"] for row in rows_of(sm.score_sentiment(titles, scorer=sm.model_scorer(load, batch_size=2)))}
    assert rows == {1: "positive", 2: "positive", 3: "positive", 4: "neutral", 5: "neutral", 6: "positive"}


@pytest.fixture
def news(spark):
    rows = [
        ("A", "a1", "positive", 0.9, "wire", "2024-01-01", "u1"), ("A", "a2", "positive", 0.8, "wire", "2024-01-02", "u2"),
        ("A", "a3", "negative", 0.9, "wire", "2024-01-03", "u3"), ("A", "a4", "neutral", 0.5, "wire", "2024-01-03", "u4"),
        ("B", "b1", "negative", 0.7, "wire", "2024-01-01", "u5"),
    ]
    return spark.createDataFrame(rows, "ticker string, title string, sentiment string, sentiment_score double, source string, published_at string, url string")


def test_summaries(news):
    found = {row["ticker"]: row for row in rows_of(ag.sentiment_summary(news))}
    assert found["A"] == {"ticker": "A", "total_articles": 4, "bullish": 2, "bearish": 1, "neutral": 1, "avg_confidence": 0.775}
    assert [row["ticker"] for row in ag.sentiment_by_ticker(news).collect()] == ["A", "B"]
    shares = {row["sentiment"]: (row["count"], row["pct"]) for row in rows_of(ag.label_distribution(news))}
    assert shares == {"positive": (2, 40.0), "negative": (2, 40.0), "neutral": (1, 20.0)}
    by_ticker = {(row["ticker"], row["sentiment"]): row["pct"] for row in rows_of(ag.label_distribution(news, by=("ticker",)))}
    assert by_ticker == {("A", "positive"): 50.0, ("A", "negative"): 25.0, ("A", "neutral"): 25.0, ("B", "negative"): 100.0}


def test_quantiles(news):
    found = {row["sentiment"]: row for row in rows_of(ag.confidence_quantiles(news))}
    assert found["negative"] == {"sentiment": "negative", "count": 2, "minimum": 0.7, "q1": 0.75, "median": 0.8, "q3": 0.85, "maximum": 0.9}


def test_reports(news):
    report = reports.sentiment_report(news, "a", limit=2)
    assert report.summary.first()["total_articles"] == 4
    assert [row["title"] for row in report.articles.collect()] == ["a1", "a3"]
    nobody = reports.sentiment_report(news, "zzz")
    assert nobody.summary.isEmpty() and nobody.articles.isEmpty()
    parts = reports.sentiment_breakdown(news, "A")
    assert parts.mean.first()["avg_confidence"] == 0.78
    assert parts.quantiles.count() == 3


def test_newest_and_top(news):
    assert sorted(row["url"] for row in rows_of(wn.newest_n(news, 2))) == ["u3", "u4", "u5"]
    assert [row["title"] for row in rk.top_articles(news, limit=3).collect()] == ["a1", "a3", "a2"]
    assert rk.top_articles(news, limit=None).count() == 5


def test_newest_is_limited_before_the_shuffle(news):
    plan = wn.newest_n(news, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_run_metrics(news):
    (row,) = rows_of(ag.run_metrics(news, 2.04, {"batch_size": 16}))
    assert row["total_headlines"] == 5 and row["headlines_per_second"] == 2.45 and row["elapsed_seconds"] == 2.0
    assert (row["positive_count"], row["positive_pct"], row["batch_size"]) == (2, 40.0, "16")
    (none,) = rows_of(ag.run_metrics(news.limit(0), 0.0))
    assert none["total_headlines"] == 0 and none["neutral_pct"] == 0.0


def test_sample_is_exact_and_repeatable(spark):
    rows = spark.range(1000)
    first = {row.id for row in rk.sample_rows(rows, 50, ["id"]).collect()}
    again = {row.id for row in rk.sample_rows(rows.repartition(7), 50, ["id"]).collect()}
    assert len(first) == 50 and first == again
    assert first != {row.id for row in rk.sample_rows(rows, 50, ["id"], seed=1).collect()}
    assert rk.sample_rows(rows, 5000, ["id"]).count() == 1000
