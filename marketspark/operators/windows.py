"""Per-key ordered operators: lag, last-wins, newest n, look-back reads, splitting of long series."""

from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.numeric import half_up, safe_div
from ..sources.scratch import stored
from .combine import union_sources
from .projections import unused
from .ranges import ranged, row_inside

#: Rows that a range of long series holds at least, so that short runs do not make tiny tasks. Shorter series stay in one task.
RANGE_ROWS = 1 << 17


def series(by=("ticker",), order: str = "date"):
    return Window.partitionBy(*by).orderBy(order)


def trailing(rows: int, by=("ticker",), order: str = "date"):
    """The current row and the ``rows - 1`` before it; shorter at the start of a series."""
    return series(by, order).rowsBetween(1 - rows, Window.currentRow)


def prev_close(df: DataFrame, n: int = 1, by=("ticker",)) -> DataFrame:
    return df.withColumn("prev_close", F.lag("close", n).over(series(by)))


def daily_return(df: DataFrame, by=("ticker",), rounding=half_up) -> DataFrame:
    """Change against the previous bar; null on the first bar of a series."""
    previous = unused(df, "_previous")
    change = safe_div(F.col("close"), F.col(previous)) - 1
    with_previous = df.withColumn(previous, F.lag("close").over(series(by)))
    return with_previous.withColumn("daily_return", rounding(change, 6)).drop(previous)


def _first_rows(df: DataFrame, by, order, n: int) -> DataFrame:
    # Spark keeps at most n rows per key in every task before the shuffle (WindowGroupLimit), so a
    # key that holds a large share of all rows does not end up whole in one task.
    place, name = F.row_number().over(Window.partitionBy(*by).orderBy(*order)), unused(df, "_place")
    return df.withColumn(name, place).filter(F.col(name) <= n).drop(name)


def newest_first(order, columns) -> list[Column]:
    """Descending over the arrival order, then over every other column, so that the order is total."""
    rest = sorted(name for name in columns if name not in order)
    return [F.col(name).desc_nulls_last() for name in [*order, *rest]]


def dedup_last(df: DataFrame, keys=("ticker", "date"), order=("ingested_at",)) -> DataFrame:
    """One row per key: the last to arrive. An arrival column that does not exist is an error."""
    others = [name for name in df.columns if name not in keys]
    return _first_rows(df, keys, newest_first(arrival_columns(df, order), others), 1)


def arrival_columns(df: DataFrame, order) -> list[str]:
    absent = [name for name in order if name not in df.columns]
    if absent:
        raise ValueError(f"no such arrival column: {', '.join(absent)}")
    return list(order)


def latest_n(df: DataFrame, n: int, by=("ticker",), order: str = "date") -> DataFrame:
    """The n most recent rows of each key."""
    return _first_rows(df, by, [F.col(order).desc_nulls_last()], n)


def newest_n(df: DataFrame, n: int = fv.ARTICLES_PER_TICKER, by=("ticker",), order: str = "published_at", tie: str = "url") -> DataFrame:
    return _first_rows(df, by, [F.col(order).desc_nulls_last(), F.col(tie).asc_nulls_last()], n)


def first_n_hits(df: DataFrame, n: int = 5, by=("ticker", "form_type"), order=("position",)) -> DataFrame:
    return _first_rows(df, by, [F.col(name).asc_nulls_last() for name in order], n)


def with_look_back(df: DataFrame, start, rows: int, by=("ticker",), order: str = "date", columns=None) -> DataFrame:
    """All rows from ``start`` on, plus the last ``rows`` before it of each key. ``columns``: what is looked back on; others are
    null in the earlier rows, neither read nor shuffled."""
    bound = F.lit(start).cast("timestamp_ntz")
    earlier = df.filter(F.col(order) < bound)
    if columns is not None:
        wanted = {*by, order, *columns}
        earlier = earlier.select(*[name for name in df.columns if name in wanted])
    later = df.filter(F.col(order) >= bound)
    return later.unionByName(latest_n(earlier, rows, by, order), allowMissingColumns=True)


def _long_series(df: DataFrame, rows: int, by) -> DataFrame:
    """Keys of the series with more than ``rows`` rows, at most one for so many rows of the table. Runs a job, which reads no other column."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    return stored(sizes.filter(F.col("_rows") > rows).select(*by))


def _in_runs(placed: DataFrame, columns, max_rows: int, look_back: int) -> DataFrame:
    """Rows with their place ``_at`` in runs of ``max_rows``, each led by copies of the ``look_back`` rows before it."""
    run = F.floor(F.col("_at") / max_rows)

    def copy(number, lead):
        return F.struct(number.alias("_run"), F.lit(lead).alias("_lead"))

    leads_next = F.col("_at") % max_rows >= max_rows - look_back
    copies = F.when(leads_next, F.array(copy(run, False), copy(run + 1, True))).otherwise(F.array(copy(run, False)))
    return placed.select(*columns, F.inline(copies))


def _split(df: DataFrame, max_rows: int, look_back: int, by, order: str) -> list[DataFrame]:
    """The runs of series that a task can sort, and of longer ones, if there are any: frames without a key in common."""
    if max_rows < look_back:
        raise ValueError("max_rows must not be smaller than look_back")
    columns, rows = df.columns, max(max_rows, RANGE_ROWS)
    keys, short, parts = _long_series(df, rows, by), df, []
    if not keys.isEmpty():
        named = F.broadcast(keys.select(*[F.col(name).alias(f"_long_{name}") for name in by]))
        same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_long_{name}")) for name in by])
        short = df.join(named, same, "left_anti")
        dealt = ranged(df.join(named, same, "left_semi"), [*by, order], rows)
        sizes = sorted(dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("rows")).collect())
        before = accumulate((rows for _, rows in sizes), initial=0)
        starts = df.sparkSession.createDataFrame([(part, start) for (part, _), start in zip(sizes, before)], "_part bigint, _before bigint")
        placed = dealt.join(F.broadcast(starts), "_part").withColumn("_at", F.col("_before") + F.col("_row") - F.col("_part"))
        parts.append(_in_runs(placed, columns, max_rows, look_back))
    # Rows keep their partitioning by series, so that windows over the runs need no shuffle of the copies.
    gathered = short.repartition(*by).sortWithinPartitions(*by, order, F.xxhash64(*columns)).withColumn("_at", row_inside())
    return [_in_runs(gathered, columns, max_rows, look_back), *parts]


def split_series(df: DataFrame, max_rows: int, look_back: int, by=("ticker",), order: str = "date") -> DataFrame:
    """Cut long series into runs so that no window holds more than ``max_rows + look_back`` rows.

    Adds ``_run`` (number of the run) and ``_lead``. A run is led by copies of the
    ``look_back`` rows before it, marked ``_lead``; windows over ``(*by, _run)`` that look back no
    further than that give exactly the values of windows over ``by``. Drop the lead rows afterwards.

    A run is so many rows in the order of key, time and row, and a run that holds several short series is one of each. Series are dealt
    to tasks by key and cut there. Those of over ``RANGE_ROWS`` rows are dealt to ranges of that order, so that a series
    is cut wherever it is long, be it on one day; where a range starts is told by
    the sizes of those before it. Runs jobs: ``df`` is counted by key; of ranges one number each reaches the driver.
    """
    return union_sources(*_split(df, max_rows, look_back, by, order))


def over_series(df: DataFrame, compute, look_back: int, max_rows: int | None = None, by=("ticker",), order: str = "date") -> DataFrame:
    """``compute(df, by)``, whose windows run over ``by`` and look back at most ``look_back`` rows.

    With ``max_rows`` long series are cut first, so that one series cannot fill one task.
    """
    if max_rows is None:
        return compute(df, tuple(by))
    parts = _split(df, max_rows, look_back, by, order)
    return union_sources(*[compute(cut, (*by, "_run")).filter(~F.col("_lead")).drop("_run", "_lead") for cut in parts])
