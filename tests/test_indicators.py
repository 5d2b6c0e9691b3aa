import random
import re
import statistics
from contextlib import redirect_stdout
from io import StringIO

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from marketspark.functions import labels
from marketspark.functions.numeric import stable
from marketspark.operators import indicators as ind
from marketspark.operators import ranges
from marketspark.operators import windows as wn
from marketspark.operators.projections import indicator_view
from marketspark.plans.clean import enrich
from marketspark.plans.indicators import add_indicators

GOLD = [
    "rsi_14", "macd_line", "macd_signal", "macd_histogram", "bb_middle", "bb_upper", "bb_lower",
    "bb_bandwidth", "bb_pct_b", "vwap", "vwap_signal", "sma_50", "sma_200", "ma_signal",
]


def gold(bars, **options):
    return add_indicators(enrich(bars), rounding=stable, audit=False, **options)


def walk(length, seed, start=50.0):
    rng, prices = random.Random(seed), [start]
    for _ in range(length - 1):
        prices.append(round(max(1.0, prices[-1] + rng.uniform(-2, 2)), 2))
    return prices


def test_single_row(make_bars):
    (row,) = rows_of(gold(make_bars({"A": [10.0]})))
    assert row["rsi_14"] == 99.01
    assert row["macd_line"] == row["macd_signal"] == row["macd_histogram"] == 0.0
    assert row["sma_50"] == row["sma_200"] == row["bb_middle"] == 10.0
    assert row["bb_upper"] is row["bb_lower"] is row["bb_bandwidth"] is row["bb_pct_b"] is None
    assert row["daily_return"] is None
    assert row["ma_signal"] == "neutral"


def test_constant_series(make_bars):
    last = rows_of(gold(make_bars({"A": [10.0] * 30})), "date")[-1]
    assert last["rsi_14"] == 99.01
    assert last["bb_bandwidth"] == 0.0
    assert last["bb_pct_b"] is None
    assert last["ma_signal"] == "neutral"
    assert last["sma_200"] == 10.0


def test_falling_series(make_bars):
    rsi = [row["rsi_14"] for row in rows_of(gold(make_bars({"A": [float(60 - n) for n in range(20)]})), "date")]
    assert rsi[0] == 99.01
    assert set(rsi[1:]) == {0.0}


def test_alternating_series(make_bars):
    rows = rows_of(gold(make_bars({"A": [10.0 + n % 2 for n in range(16)]})), "date")
    assert rows[1]["rsi_14"] == 99.01  # a gain and no loss
    assert rows[2]["rsi_14"] == 50.0
    assert rows[15]["rsi_14"] == 50.0  # seven gains and seven losses in the last 14 rows


def test_against_plain_python(make_bars):
    closes = {"A": walk(260, 1), "B": walk(199, 2), "C": walk(50, 3)}
    found = rows_of(gold(make_bars(closes)), "ticker", "date")
    at = 0
    for ticker in sorted(closes):
        series = closes[ticker]
        lines = []
        for n, close in enumerate(series):
            row = found[at]
            at += 1

            def last(k):
                return series[max(0, n - k + 1) : n + 1]

            steps = [series[i] - series[i - 1] if i else 0.0 for i in range(max(0, n - 13), n + 1)]
            gain = sum(max(step, 0) for step in steps) / len(steps)
            loss = sum(max(-step, 0) for step in steps) / len(steps)
            strength = gain / loss if loss else 100.0
            assert row["rsi_14"] == pytest.approx(100 - 100 / (1 + strength), abs=0.00501)
            assert row["sma_50"] == pytest.approx(statistics.fmean(last(50)), abs=5.1e-5)
            assert row["sma_200"] == pytest.approx(statistics.fmean(last(200)), abs=5.1e-5)
            lines.append(row["macd_line"])
            assert row["macd_line"] == pytest.approx(statistics.fmean(last(12)) - statistics.fmean(last(26)), abs=5.1e-5)
            assert row["macd_signal"] == pytest.approx(statistics.fmean(lines[-9:]), abs=5.1e-5)
            if n:
                width = 2 * statistics.stdev(last(20))
                assert row["bb_upper"] == pytest.approx(row["bb_middle"] + width, abs=5.1e-5)
                assert row["bb_lower"] == pytest.approx(row["bb_middle"] - width, abs=5.1e-5)
                assert row["bb_lower"] <= row["bb_middle"] <= row["bb_upper"]
            assert 0 <= row["rsi_14"] <= 100


def test_vwap_zero_volume_and_missing_prices(make_bars):
    rows = rows_of(gold(make_bars({"A": [10.0, 11.0, 12.0]}, volume=[0.0, 0.0, 0.0])), "date")
    assert [row["vwap"] for row in rows] == [None] * 3
    assert [row["vwap_signal"] for row in rows] == ["at"] * 3
    # A bar without a high has no typical price, but its volume still counts.
    bars = make_bars({"A": [10.0, 10.0]}, high=[10.0, None], low=[10.0, 10.0], volume=[100.0, 300.0])
    rows = rows_of(gold(bars), "date")
    assert [row["vwap"] for row in rows] == [10.0, 2.5]


def test_vwap_within_typical_prices(make_bars):
    rows = rows_of(gold(make_bars({"A": walk(80, 9)})), "date")
    for n, row in enumerate(rows):
        window = [one["typical_price"] for one in rows[max(0, n - 19) : n + 1]]
        assert min(window) - 1e-4 <= row["vwap"] <= max(window) + 1e-4


@pytest.mark.parametrize("max_rows", [199, 200, 333, 1000])
def test_split_series_gives_the_same_values(make_bars, max_rows):
    bars = make_bars({"A": walk(750, 4), "B": walk(200, 5), "C": walk(3, 6)})
    whole, split = gold(bars), gold(bars, max_rows=max_rows)
    assert split.columns == whole.columns
    assert split.count() == 953
    assert whole.exceptAll(split).isEmpty()


def test_split_series_bounds_every_run(make_bars):
    cut = wn.split_series(make_bars({"A": walk(1000, 7), "B": walk(10, 8)}), 250, 199)
    runs = cut.groupBy("ticker", "_run").agg(F.count("*").alias("n"), F.count_if(~F.col("_lead")).alias("own"))
    found = {(row["ticker"], row._run): (row.n, row.own) for row in runs.collect()}
    assert max(n for n, _ in found.values()) <= 250 + 199
    assert sum(own for _, own in found.values()) == 1010
    with pytest.raises(ValueError):
        wn.split_series(make_bars({"A": [1.0]}), 10, 199)


def test_split_series_with_many_rows_on_one_day(spark):
    """Intraday rows, most of them of one ticker on one day."""
    ticks = spark.range(3000).select(
        F.when(F.col("id") % 100 == 0, "B").otherwise("A").alias("ticker"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("date"),
        (F.col("id") % 37 + 1).cast("double").alias("close"),
    )
    ticks = ticks.withColumns({"open": F.col("close"), "high": F.col("close") + 1, "low": F.col("close") * 0.5, "volume": F.col("close")})
    assert gold(ticks).exceptAll(gold(ticks, max_rows=500)).isEmpty()


@pytest.mark.parametrize("rows", [200, 450])
def test_split_series_over_many_ranges(spark, monkeypatch, rows):
    """One ticker holds most rows, most of them on one day: its day is many ranges, and look-back rows cross their borders."""
    monkeypatch.setattr(wn, "RANGE_ROWS", rows)
    ticks = spark.range(2400).select(
        F.when(F.col("id") % 50 == 0, "B").when(F.col("id") % 601 == 0, None).otherwise("A").alias("ticker"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * F.when(F.col("id") > 2000, 600).otherwise(1))).alias("date"),
        (F.col("id") % 37 + 1).cast("double").alias("close"),
    )
    ticks = ticks.withColumns({"open": F.col("close"), "high": F.col("close") + 1, "low": F.col("close") * 0.5, "volume": F.col("close")})
    split = gold(ticks, max_rows=200)
    assert split.count() == 2400 and gold(ticks).exceptAll(split).isEmpty()
    cut = wn.split_series(ticks, 200, 199)
    assert cut.groupBy("ticker", "_run").count().agg(F.max("count")).first()[0] <= 399
    dealt = ranges.ranged(ticks, ["ticker", "date"], rows).groupBy("_part").count()
    assert dealt.agg(F.max("count")).first()[0] <= 2 * rows


def test_runs_of_short_series_share_one_shuffle(make_bars):
    """Series that a task can sort are cut there: neither they nor the copies that lead their runs are stored, ranged or dealt again."""
    plan = gold(make_bars({"A": walk(700, 18), "B": walk(30, 19)}), max_rows=200)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Exchange hashpartitioning(ticker" in plan


def test_split_series_of_both_kinds(spark, make_bars, monkeypatch):
    """Series for ranges, the one without a ticker among them, beside series for one task."""
    monkeypatch.setattr(wn, "RANGE_ROWS", 300)
    bars = make_bars({"A": walk(750, 20), "B": walk(290, 21), "C": walk(400, 22), "D": walk(5, 23)})
    bars = bars.withColumn("ticker", F.nullif("ticker", F.lit("C")))
    split = gold(bars, max_rows=200)
    assert split.count() == 1445 and gold(bars).exceptAll(split).isEmpty()


def test_since_reads_only_the_look_back(make_bars):
    bars = make_bars({"A": walk(500, 10), "B": walk(30, 11)})
    whole = gold(bars).filter(F.col("date") >= F.lit("2025-01-01").cast("timestamp_ntz"))
    assert whole.count() > 0
    assert whole.exceptAll(gold(bars, start="2025-01-01")).isEmpty()


def test_rows_and_keys_are_kept(make_bars):
    bars = make_bars({"A": walk(40, 12), "B": walk(25, 13)})
    out = add_indicators(enrich(bars))
    assert out.count() == 65
    assert bars.select("ticker", "date").exceptAll(out.select("ticker", "date")).isEmpty()
    assert set(GOLD) <= set(out.columns)
    assert not [name for name in out.columns if name.startswith("_")]


def test_all_indicators_share_one_shuffle(make_bars):
    plan = gold(make_bars({"A": walk(5, 15)}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_parameters_and_labels(spark, make_bars):
    out = ind.moving_averages(make_bars({"A": walk(10, 16)}), fast=2, slow=4)
    assert {"sma_2", "sma_4"} <= set(out.columns)
    values = spark.createDataFrame([(70.0, 0.0), (70.1, 0.1), (29.9, -1.0), (None, None)], "rsi double, line double")
    found = values.select(labels.rsi_band(F.col("rsi")).alias("band"), labels.macd_sign(F.col("line")).alias("sign")).collect()
    assert [tuple(row) for row in found] == [("neutral", "bearish"), ("overbought", "bullish"), ("oversold", "bearish"), ("neutral", "bearish")]


def test_projections_compile_to_short_methods(spark, make_bars):
    """The JVM interprets a method of more than 8000 bytes, which makes a projection several times slower."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with redirect_stdout(StringIO()) as shown:
            indicator_view(gold(make_bars({"A": walk(40, 14)})), stable).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
    assert sizes and max(sizes) < 8000


@pytest.mark.parametrize("rows", [7, 200, 450])
def test_ranges_are_cut_from_tasks(spark, monkeypatch, rows):
    """Short ranges make no tasks and files of their own, and follow each other in order, over several tasks as well."""
    monkeypatch.setattr(ranges, "TASK_ROWS", 300, raising=False)
    frame = spark.range(2000).select((F.col("id") * 7919 % 1000).alias("x"), "id")
    dealt = ranges.ranged(frame, ["x"], rows)
    assert len(dealt.inputFiles()) <= 10 and dealt.select(*frame.columns).exceptAll(frame).isEmpty()
    parts = sorted(tuple(row) for row in dealt.groupBy("_part").agg(F.min("x"), F.max("x"), F.count("*")).collect())
    assert sum(part[3] for part in parts) == 2000 and max(part[3] for part in parts) <= 2 * rows
    assert all(one[2] <= other[1] for one, other in zip(parts, parts[1:]))


def test_split_series_over_many_tasks(spark, make_bars, monkeypatch):
    """Tasks of 60 rows, fewer than a look-back: lead rows come over several of them. Nothing is joined by key or numbered again."""
    monkeypatch.setattr(ranges, "TASK_ROWS", 60, raising=False)
    monkeypatch.setattr(wn, "RANGE_ROWS", 60)
    bars = make_bars({"A": walk(750, 15), "B": walk(200, 16), "C": walk(3, 17)})
    whole, split = gold(bars), gold(bars, max_rows=200)
    assert split.count() == 953 and whole.exceptAll(split).isEmpty()
    plan = wn.split_series(bars, 200, 199)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_slow_mean_adds_fast_sums(spark, make_bars):
    """The slow window is no frame of its own, and is the mean over it: at a start, over gaps, over very large and tiny closes."""
    closes = [float(n * n % 97 + 1) * (1e9 if 300 < n < 330 else 1e-3 if n % 11 == 0 else 1.0) for n in range(700)]
    bars = make_bars({"A": closes, "B": [0.1] * 260, "C": [-1.0] * 60 + [2.0] * 3}).withColumn("close", F.nullif("close", F.lit(-1.0)))
    found = ind.moving_averages(bars, rounding=lambda value, places: value)
    assert "-199" not in found._jdf.queryExecution().optimizedPlan().toString()
    wanted = bars.withColumn("mean", F.avg("close").over(wn.trailing(200)))
    rows = rows_of(found.join(wanted.select("ticker", "date", "mean"), ["ticker", "date"]), "ticker", "date")
    assert len(rows) == 1023
    for row in rows:
        assert (row["sma_200"] is None) == (row["mean"] is None)
        assert row["mean"] is None or row["sma_200"] == pytest.approx(row["mean"], rel=1e-13)
    odd = ind.moving_averages(bars, fast=7, slow=20)
    plain = bars.withColumn("sma", F.round(F.avg("close").over(wn.trailing(20)), 4))
    assert odd.join(plain, ["ticker", "date"]).filter(~F.col("sma_20").eqNullSafe(F.col("sma"))).isEmpty()
