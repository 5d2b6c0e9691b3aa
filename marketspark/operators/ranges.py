"""Rows in ranges of an order, of about equal size whatever the keys."""

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored

#: Rows that a task deals with at least; shorter ranges are cut from its rows, so that they make no tasks and files of their own.
TASK_ROWS = 1 << 17
#: ``monotonically_increasing_id`` has the row inside its partition in these bits.
_INSIDE = (1 << 33) - 1


def row_inside() -> Column:
    """The place of a row in its partition, as it lies there."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit(_INSIDE))


def ranged(df: DataFrame, order, rows: int) -> DataFrame:
    """The rows with ``_row``, which ascends in ``order``, and ``_part``, the first ``_row`` of their range; ranges follow each
    other in ``order`` and hold at most ``rows`` rows, or about that many where a range is as long as a task's rows.

    Bounds of tasks are sampled, and rows equal in ``order`` are parted by the hash of the whole row, so that a key, a day or a value
    with a third of all rows is many ranges. Stores the rows before they are counted, sampled and dealt, so that what made them runs
    once, and again with their place: what reads the ranges later sees the same ones.
    """
    df = stored(df)
    tasks = max(1, ceil(df.count() / max(rows, TASK_ROWS)))
    by = [*order, F.xxhash64(*df.columns)]
    dealt = df.repartitionByRange(tasks, *by).sortWithinPartitions(*by)
    placed = stored(dealt.withColumn("_row", F.monotonically_increasing_id()))
    inside = F.col("_row").bitwiseAND(F.lit(_INSIDE))
    return placed.withColumn("_part", F.col("_row") - (inside % rows if rows < TASK_ROWS else inside))
