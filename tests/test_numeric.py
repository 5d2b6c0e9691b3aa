import random

from pyspark.sql import functions as F

from marketspark.functions.numeric import half_up, safe_div, stable, to_number, to_whole


def test_half_up_is_sparks_round(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1, 1) * 10 ** rng.randrange(-6, 14) for _ in range(4000)]
    values += [rng.randrange(-(10**7), 10**7) / 2 / 10 ** rng.randrange(0, 7) for _ in range(4000)]  # ties
    values += [n / 200 for n in range(-2000, 2000)] + [0.0, -0.0, 1e300, -1e300, float("inf"), float("-inf"), 1.005, 2.675, 1e12, 0.00005, -0.00005]
    frame = spark.createDataFrame([(value,) for value in values] + [(None,)], "x double")
    x = F.col("x")
    for places in (0, 1, 2, 4, 6):
        other = frame.select("x", half_up(x, places).alias("a"), F.round(x, places).alias("b"))
        assert other.filter(~F.col("a").eqNullSafe(F.col("b"))).collect() == []


def test_stable_ignores_the_last_bits(spark):
    rng = random.Random(2)
    exact = [rng.randrange(1, 10**9) / 200 for _ in range(5000)]  # at 2 places half of them are ties
    frame = spark.createDataFrame([(value, value * (1 + rng.choice((-2, 2)) * 2.3e-16)) for value in exact], "x double, y double")
    both = frame.select(stable(F.col("x"), 2).alias("a"), stable(F.col("y"), 2).alias("b"))
    assert both.filter("a <> b").isEmpty()


def test_stable_by_its_definition(spark):
    rng = random.Random(3)
    frame = spark.createDataFrame([(rng.uniform(-1e5, 1e5),) for _ in range(5000)] + [(n / 8e4,) for n in range(2000)], "x double")
    plain = F.floor(F.round("x", 8) * 1e4 + 0.5) / 1e4
    assert frame.filter(stable(F.col("x"), 4) != plain).isEmpty()


def test_safe_numbers(spark):
    frame = spark.createDataFrame([("1.5",), ("abc",), ("NaN",), (None,), ("Infinity",)], "t string")
    assert [row[0] for row in frame.select(to_number("t")).collect()] == [1.5, None, None, None, float("inf")]
    halves = spark.createDataFrame([(2.5,), (3.5,), (-2.5,), (None,)], "x double")
    assert [row[0] for row in halves.select(to_whole(F.col("x"))).collect()] == [2, 4, -2, None]
    assert spark.range(1).select(safe_div(F.lit(1.0), F.lit(0.0))).first()[0] is None
