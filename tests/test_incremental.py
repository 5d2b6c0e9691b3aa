from datetime import datetime, timedelta

import pytest
from conftest import TINY, rows_of
from pyspark.sql import functions as F

from checks import fixtures as fx
from marketspark.operators import indicators as ind
from marketspark.operators import quality as q
from marketspark.operators.windows import with_look_back
from marketspark.plans import incremental
from marketspark.plans.clean import clean_prices
from marketspark.plans.indicators import LOOKED_BACK_ON, add_indicators
from marketspark.sources import writers


def bars(spark, closes, start=datetime(2022, 11, 1), arrival=1):
    rows = [(t, start + timedelta(days=n), c, c * 1.01, c * 0.99, c, 10.0, arrival) for t, series in closes.items() for n, c in enumerate(series)]
    return spark.createDataFrame(rows, "ticker string, date timestamp_ntz, open double, high double, low double, close double, volume double, arrival int")


def same(lake, everything):
    whole = clean_prices(everything, "feed", ("arrival",), audit=False)
    silver = lake.read("silver").drop("year", "silver_processed_at").select(whole.columns)
    assert silver.count() == whole.count() and whole.exceptAll(silver).isEmpty()
    gold = add_indicators(whole, audit=False)
    found = lake.read("gold").select(gold.columns)
    assert found.count() == gold.count() and gold.exceptAll(found).isEmpty()


def test_landings_equal_one_full_run(spark, tmp_path):
    """A new day, a correction of an old bar, a new ticker in between, and a row without a date."""
    lake = incremental.Lake(spark, str(tmp_path), "feed", ("arrival",))
    assert lake.read("silver") is None
    first = bars(spark, {"A": [10.0 + n % 7 for n in range(300)], "B": [5.0, 6.0]})
    assert lake.refresh(first) == 2022
    same(lake, first)
    day = bars(spark, {"A": [12.0]}, datetime(2023, 8, 28), 2)
    assert lake.refresh(day) == 2023
    same(lake, first.unionByName(day))
    # The years before are still read from the first run's folder.
    assert len(lake.segments("silver")) == 2
    late = bars(spark, {"A": [99.0], "C": [1.0, 2.0]}, datetime(2022, 12, 30), 3)
    lake.refresh(late)
    same(lake, first.unionByName(day).unionByName(late))
    undated = day.withColumn("date", F.lit(None).cast("timestamp_ntz"))
    assert lake.refresh(undated) is None
    same(lake, first.unionByName(day).unionByName(late))


def test_failed_run_changes_nothing(spark, tmp_path, monkeypatch):
    lake = incremental.Lake(spark, str(tmp_path), "feed", ("arrival",))
    first = bars(spark, {"A": [1.0, 2.0, 3.0]})
    lake.refresh(first)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental.Lake, "_gold", broken)
        with pytest.raises(RuntimeError):
            lake.refresh(bars(spark, {"A": [9.0]}, datetime(2022, 11, 2), 2))
    same(lake, first)
    assert lake.read("bronze").count() == 3
    again = bars(spark, {"A": [9.0]}, datetime(2022, 11, 2), 2)
    lake.refresh(again)
    same(lake, first.unionByName(again))


def test_bucketed_table_needs_no_shuffle_and_no_sort(spark, tmp_path):
    name = "silver_in_buckets"
    table = writers.materialize(fx.silver(spark, TINY), name, "table", ("ticker",), 4, ("ticker", "date"), str(tmp_path / "table"))
    setting = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    spark.conf.set(setting, "true")
    try:
        plan = add_indicators(table)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort [" not in plan
        assert ind.rsi(table).exceptAll(ind.rsi(fx.silver(spark, TINY))).isEmpty()
    finally:
        spark.conf.unset(setting)
        spark.sql(f"DROP TABLE {name}")


def test_broken_files_are_rows(spark, tmp_path):
    good = tmp_path / "data"
    spark.range(100).repartition(3).write.parquet(str(good))
    whole = next(good.glob("part-*.parquet")).read_bytes()
    (good / "part-99999.parquet").write_bytes(whole[:-20])
    (good / "part-99998.parquet").write_bytes(b"")
    spark.range(0).write.parquet(str(good / "none"))
    found = {row["path"].rsplit("/", 1)[1]: row for row in rows_of(q.unreadable_files(spark, str(good)))}
    assert set(found) == {"part-99999.parquet", "part-99998.parquet"} and found["part-99998.parquet"]["bytes"] == 0
    (row,) = rows_of(q.dataset_health(spark, {"data": str(good)}))
    assert (row["rows"], row["error"]) == (100, "UNREADABLE_FILES: 2")
    only = tmp_path / "only"
    only.mkdir()
    (only / "a.parquet").write_bytes(whole[:-20])
    (row,) = rows_of(q.dataset_health(spark, {"only": str(only)}))
    assert (row["rows"], row["error"]) == (None, "UNREADABLE_FILES: 1")


def test_only_bronze_is_dealt_by_year(spark, tmp_path, monkeypatch):
    """Silver and gold come out of a shuffle by ticker and are written from where they lie."""
    plans, written = [], incremental.by_year

    def seen(df, **options):
        plans.append(written(df, **options))
        return plans[-1]

    monkeypatch.setattr(incremental, "by_year", seen)
    first = bars(spark, {"A": [1.0 + n for n in range(80)], "B": [5.0, 6.0]})
    lake = incremental.Lake(spark, str(tmp_path), "feed", ("arrival",))
    lake.refresh(first)
    assert ["RebalancePartitions" in df._jdf.queryExecution().optimizedPlan().toString() for df in plans] == [True, False, False]
    same(lake, first)


def test_layers_are_packed_and_look_back_is_narrow(spark, tmp_path):
    """Layers take less space than with snappy, and rows that are only looked back on bring no other columns into the shuffle."""
    lake = incremental.Lake(spark, str(tmp_path), "feed", ("arrival",))
    first = bars(spark, {"A": [1.0 + n for n in range(80)], "B": [5.0, 6.0]})
    lake.refresh(first)
    files = [path.name for layer in ("bronze", "silver", "gold") for path in (tmp_path / layer).rglob("*.parquet")]
    assert files and all(name.endswith(".zstd.parquet") for name in files)
    silver = lake.read("silver").drop("year")
    last = silver.agg(F.max("date")).first()[0]
    rows = with_look_back(silver, last, 5, columns=LOOKED_BACK_ON)
    assert rows.columns == silver.columns
    earlier = rows.filter(F.col("date") < F.lit(last))
    assert earlier.filter("close IS NOT NULL AND typical_price IS NOT NULL").count() == earlier.count() > 0
    assert earlier.filter("open IS NOT NULL OR data_source IS NOT NULL").isEmpty()
