"""Time slices that spread the rows of one hot key over several tasks.

Work that follows the rows of a key in time order is done within (key, slice); what a slice hands on to the next ones is one row
per key and slice, so the second step, by key alone, sees few rows even where one key holds a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows that make a further slice, or a further task, worth while, and the most slices; the bounds are one conditional expression.
SLICE_ROWS = 1_000_000
MOST_SLICES = 256


def _tree(value: Column, bounds: Sequence[int], first: int) -> Column:
    """Number of the slice of ``value``, found by halving: ``first`` plus how many bounds lie below it."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    left, right = _tree(value, bounds[:middle], first), _tree(value, bounds[middle + 1 :], first + middle + 1)
    return F.when(value <= bounds[middle], left).otherwise(right)


def ticks(time: Column) -> Column:
    """A date or timestamp as a whole number that orders like it."""
    return F.unix_micros(time.cast("timestamp"))


def slice_of(df: DataFrame, time: Column, rows: int | None = None) -> Column:
    """An expression for the slice number (from 0) of a time; slices hold about equally many rows of ``df``.

    Rows without a time are in slice 0. One aggregate of ``df``; a small one gives a single slice.
    """
    rows = df.count() if rows is None else rows
    slices = min(max(rows // SLICE_ROWS, 1), MOST_SLICES)
    if slices == 1:
        return F.lit(0)
    shares = [i / slices for i in range(1, slices)]
    bounds = df.agg(F.percentile_approx(ticks(time), shares, 20 * slices)).first()[0]
    distinct = sorted(set(bounds or ()))
    return F.when(time.isNull(), 0).otherwise(_tree(ticks(time), distinct, 0))


def spread(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """``df`` dealt by columns over a task for every ``SLICE_ROWS`` of ``rows``, where the session's shuffle would use fewer.

    What a task sorts is then as much at every size, and does not grow with the table. Smaller tables are left to the session.
    """
    tasks = 1 + rows // SLICE_ROWS
    return df.repartition(tasks, *by) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def handed_on(
    totals: DataFrame, by: Sequence[str], slice_col: str, value: str, forward: bool = True, greatest: bool = False
) -> DataFrame:
    """``totals`` (a row per key and slice) with ``value`` replaced by the nearest known one of the slices before it.

    By the greatest of them with ``greatest``; of the slices after it where ``forward`` is off. Slices that are handed nothing are left out. The result is meant to be put among the
    rows of its slice, as their first or last one, so that no join is needed.
    """
    order = F.col(slice_col) if forward else F.desc(slice_col)
    earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    taken = F.max(value) if greatest else F.last(value, ignorenulls=True)
    return totals.withColumn(value, taken.over(earlier)).where(F.col(value).isNotNull())
