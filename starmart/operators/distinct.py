"""Distinct values over sliding windows of periods, exact and by stored sketches that merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .snapshots import PERIOD

SKETCH = "sketch"
# Binary logarithm of the sketch's buckets: a standard error of about 0.8 % in 16 KB at most.
SKETCH_BITS = 14


def _period(time: str, grain: str) -> Column:
    return F.date_trunc(grain, F.col(time)).cast("date").alias(PERIOD)


def period_sketches(df: DataFrame, by: Sequence[str], time: str, value: str, grain: str = "month") -> DataFrame:
    """One mergeable sketch of the values of each group and period, to be stored; nulls are no values.

    A task holds one sketch of bounded size per group and period, whatever the number of rows or values.
    """
    known = df.where(F.col(value).isNotNull() & F.col(time).isNotNull())
    return known.groupBy(*by, _period(time, grain)).agg(F.hll_sketch_agg(value, F.lit(SKETCH_BITS)).alias(SKETCH))


def period_values(df: DataFrame, by: Sequence[str], time: str, value: str, grain: str = "month") -> DataFrame:
    """The distinct values of each group and period, to be stored beside the sketches where counts must be exact."""
    known = df.where(F.col(value).isNotNull() & F.col(time).isNotNull())
    return known.select(*by, _period(time, grain), value).distinct()


def _into_windows(df: DataFrame, width: int, grain: str) -> DataFrame:
    """Each row once for every window of ``width`` periods that holds its period; a window is named by its last period.

    Windows end with a period that occurs in the data, or between two that do.
    """
    last = df.agg(F.max(PERIOD)).first()[0]
    step = F.expr(f"interval 1 {grain}")
    until = F.least((F.col(PERIOD) + F.expr(f"interval {width - 1} {grain}")).cast("date"), F.lit(last).cast("date"))
    return df.withColumn(PERIOD, F.explode(F.sequence(F.col(PERIOD), until, step)))


def distinct_in_windows(values: DataFrame, by: Sequence[str], value: str, width: int, grain: str = "month") -> DataFrame:
    """``n_distinct`` of each group and window, from ``period_values``.

    In two steps, values first and then their number, so no task gathers the values of a window.
    """
    inside = _into_windows(values, width, grain).select(*by, PERIOD, value).distinct()
    return inside.groupBy(*by, PERIOD).agg(F.count(F.lit(1)).alias("n_distinct"))


def sketched_in_windows(sketches: DataFrame, by: Sequence[str], width: int, grain: str = "month") -> DataFrame:
    """``n_sketched``, the estimate for each group and window, from ``period_sketches`` alone."""
    merged = _into_windows(sketches, width, grain).groupBy(*by, PERIOD)
    return merged.agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias("n_sketched"))
