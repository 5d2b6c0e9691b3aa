import random
from datetime import date, timedelta

import pytest
from conftest import rows_of

from marketspark.operators import aggregates as ag
from marketspark.operators import combine as cb
from marketspark.operators import ranking as rk
from marketspark.operators.projections import display_names
from marketspark.plans import marts, reports

STG = "ticker string, price_date date, close_price double, daily_return double, volume bigint, range_pct double"
DAY = date(2024, 3, 1)


@pytest.fixture
def staging(spark):
    def make(returns, day=DAY):
        return spark.createDataFrame([(f"T{n:03}", day, 10.0 + n, value, 100, 1.5) for n, value in enumerate(returns)], STG)

    return make


def brute_ranks(values):
    return {value: (1 + sum(other > value for other in values), 1 + sum(other < value for other in values)) for value in values}


@pytest.mark.parametrize("seed,size,spread", [(1, 200, 1000), (2, 200, 6), (3, 15, 1000), (4, 4, 3), (5, 60, 1)])
def test_movers_against_brute_force(staging, seed, size, spread):
    rng = random.Random(seed)
    values = [rng.randrange(-spread, spread + 1) / 1000 for _ in range(size)]
    ranks = brute_ranks(values)
    stg = staging(values)
    expected = sorted(
        (f"T{n:03}", *ranks[value], "top_gainer" if ranks[value][0] <= 10 else "top_loser")
        for n, value in enumerate(values) if min(ranks[value]) <= 10
    )
    found = rows_of(marts.mart_top_movers(stg))
    assert sorted((row["ticker"], row["gainer_rank"], row["loser_rank"], row["mover_type"]) for row in found) == expected
    assert [row["daily_return_pct"] for row in found] == sorted((row["daily_return_pct"] for row in found), reverse=True)
    every = rows_of(rk.rank_movers(stg), "ticker")
    assert [(row["gainer_rank"], row["loser_rank"]) for row in every] == [ranks[value] for value in values]


@pytest.mark.parametrize("rows", [7, 50, 1000])
def test_ranks_over_many_ranges(spark, rows):
    """Values that go over several ranges have one rank; no window sees all rows, nothing is joined on a return."""
    rng = random.Random(rows)
    values = [rng.choice([0.0, 0.0, 0.0, -0.01, 0.02, rng.random() - 0.5, float("nan"), None]) for _ in range(400)]
    returns = spark.createDataFrame(list(enumerate(values)), "n int, daily_return double").repartition(3)
    ranked = rk.rank_movers(returns, rows=rows)
    real = [value for value in values if value is not None and value == value]
    expected = {(n, sum(x > v for x in real) + 1, sum(x < v for x in real) + 1) for n, v in enumerate(values) if v is not None and v == v}
    assert {(row["n"], row["gainer_rank"], row["loser_rank"]) for row in ranked.collect()} == expected
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "hashpartitioning(daily_return" not in plan


def test_few_tickers_are_all_gainers(staging):
    rows = rows_of(marts.mart_top_movers(staging([0.1, -0.2, 0.3])))
    assert [row["mover_type"] for row in rows] == ["top_gainer"] * 3
    report = reports.top_movers(marts.mart_top_movers(staging([0.1, -0.2, 0.3])))
    assert report.date.first()["date"] == "2024-03-01"
    assert report.gainers.count() == 3 and report.losers.isEmpty()


def test_only_the_latest_date_and_known_returns(staging):
    both = staging([0.5, 0.6], DAY - timedelta(days=1)).unionByName(staging([None, 0.1, -0.0]))
    rows = rows_of(marts.mart_top_movers(both))
    assert [row["ticker"] for row in rows] == ["T001", "T002"]
    assert cb.latest_date(both).first()["max_date"] == DAY
    assert cb.at_latest_date(both).count() == 3


def test_no_rows(staging):
    empty = staging([0.1]).limit(0)
    assert marts.mart_top_movers(empty).isEmpty()
    assert marts.mart_daily_returns(empty).isEmpty()


def test_daily_return_stats(spark):
    rows = [("A", DAY + timedelta(days=n), close, value, 10 * n, 0.0) for n, (close, value) in enumerate([(10.0, None), (11.0, 0.1), (9.9, -0.1), (10.89, 0.1)])]
    rows += [("B", DAY, 5.0, 0.02, 7, 0.0), ("C", DAY, 5.0, None, 7, 0.0)]
    found = {row["ticker"]: row for row in rows_of(marts.mart_daily_returns(spark.createDataFrame(rows, STG)))}
    assert set(found) == {"A", "B"}
    first = found["A"]
    assert first["trading_days"] == 3
    assert first["avg_daily_return_pct"] == 3.3333 and first["volatility_pct"] == 11.547
    assert (first["best_day_pct"], first["worst_day_pct"]) == (10.0, -10.0)
    assert (first["avg_close"], first["max_close"], first["min_close"]) == (10.6, 11.0, 9.9)
    assert first["avg_volume"] == 20.0 and first["return_risk_ratio"] == 0.2887
    assert (first["first_date"], first["last_date"]) == (DAY + timedelta(days=1), DAY + timedelta(days=3))
    assert found["B"]["volatility_pct"] is None and found["B"]["return_risk_ratio"] == 0.0


def test_performance_and_headings(spark):
    rows = [(f"T{n}", DAY, 5.0, n / 100, 7, 0.0) for n in range(15)]
    top = reports.performance(ag.daily_return_stats(spark.createDataFrame(rows, STG)), 3)
    assert [row["ticker"] for row in top.collect()] == ["T14", "T13", "T12"]
    assert display_names(top, "performance").columns[:3] == ["Ticker", "Days", "Avg Return %"]


def test_keep_movers_broadcasts_only_the_edge_values(staging):
    plan = rk.keep_movers(staging([0.1, 0.2]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("TakeOrderedAndProject(limit=10") >= 2
    assert "CartesianProduct" not in plan
