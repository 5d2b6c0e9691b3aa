from conftest import TINY, rows_of

from checks import fixtures as fx
from marketspark.plans import clean, marts, refresh
from marketspark.operators.projections import stg_prices
from marketspark.sources import readers, writers


def test_full_run_over_two_feeds(spark, tmp_path):
    raw = fx.raw_prices(spark, TINY)
    result = refresh.refresh({"feed": raw, "other": raw.limit(500)}, str(tmp_path), order=fx.ARRIVAL)
    stats = {row["source"]: row for row in rows_of(result["stats"])}
    assert set(stats) == {"feed", "other"} and stats["other"]["input_rows"] == 500
    for source in stats:
        assert stats[source]["output_rows"] == readers.read_silver(spark, str(tmp_path), source).count() > 0
    assert {row["status"] for row in rows_of(result["checks"])} == {"passed"}
    assert result["checks"].count() == 6

    stg = stg_prices(clean.clean_prices(raw, "feed", fx.ARRIVAL))
    for name, mart in (("mart_daily_returns", marts.mart_daily_returns(stg)), ("mart_top_movers", marts.mart_top_movers(stg))):
        written = result["tables"][name]
        assert written.count() == mart.count() > 0
        assert written.exceptAll(mart).isEmpty()


def test_rerun_gives_the_same_tables(spark, tmp_path):
    raw = fx.raw_prices(spark, TINY)
    first = rows_of(refresh.refresh({"feed": raw}, str(tmp_path), order=fx.ARRIVAL)["tables"]["mart_daily_returns"], "ticker")
    again = rows_of(refresh.refresh({"feed": raw}, str(tmp_path), order=fx.ARRIVAL)["tables"]["mart_daily_returns"], "ticker")
    assert first == again


def test_silver_is_written_without_a_second_shuffle(spark, tmp_path, monkeypatch):
    """Rows dealt by ticker are written by year from where they lie."""
    plans = []
    written = writers.by_year

    def seen(df, *args, **options):
        plans.append(written(df, *args, **options))
        return plans[-1]

    monkeypatch.setattr(writers, "by_year", seen)
    raw = fx.raw_prices(spark, TINY)
    refresh.refresh_source(raw, "feed", str(tmp_path), fx.ARRIVAL)
    (plan,) = [df._jdf.queryExecution().optimizedPlan().toString() for df in plans]
    assert "RebalancePartitions" not in plan
    assert readers.read_silver(spark, str(tmp_path), "feed").count() == clean.clean_prices(raw, "feed", fx.ARRIVAL).count()
