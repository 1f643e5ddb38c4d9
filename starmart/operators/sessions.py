"""Sessions: runs of a key's events without a longer gap."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .slices import handed_on, slice_of, spread, ticks
from .staged import stage

START, END, EVENTS = "session_start", "session_end", "n_events"


def sessions(spans: DataFrame, keys: Sequence[str], gap: timedelta, sums: Sequence[str] = ()) -> DataFrame:
    """Spans put together to sessions: keys, ``session_start``, ``session_end``, ``n_events`` and the sums.

    A span has the columns of a session, and an event is a span that ends when it starts; so sessions of earlier events and new events can
    be put together, in any order. A span belongs to the session before it if it starts no more than ``gap`` after that
    one's end. Spans without a start are left out; null keys are keys like others.

    Spans are followed within key and time slice; the latest end and the open session are handed on from slice to slice, so a key with
    a third of all events spans as many tasks as slices.
    """
    spans = stage(spans.where(F.col(START).isNotNull()).select(*keys, START, END, EVENTS, *sums), "spans")
    rows = spans.count()
    sliced = spans.withColumn("_slice", slice_of(spans, F.col(START), rows))
    order = [F.asc_nulls_first(START), F.col(END)]
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(*order)
    before = in_slice.rowsBetween(Window.unboundedPreceding, -1)

    # The latest end of the slices before stands first in its slice, without a start.
    latest = spread(sliced, rows, *keys, "_slice").groupBy(*keys, "_slice").agg(F.max(END).alias(END))
    begins = handed_on(spread(latest, rows, *keys), keys, "_slice", END, greatest=True)
    lined = spread(sliced.unionByName(begins, allowMissingColumns=True), rows, *keys, "_slice")
    reached = F.max(END).over(before)
    apart = reached.isNull() | (ticks(F.col(START)) - ticks(reached) > int(gap / timedelta(microseconds=1)))
    marked = lined.withColumn("_opens", F.when(apart, F.col(START))).where(F.col(START).isNotNull())
    marked = stage(marked, "session-starts")

    opened = spread(marked, rows, *keys, "_slice").groupBy(*keys, "_slice").agg(F.max("_opens").alias("_opens"))
    begins = handed_on(spread(opened, rows, *keys), keys, "_slice", "_opens")
    lined = spread(marked.unionByName(begins, allowMissingColumns=True), rows, *keys, "_slice")
    so_far = in_slice.rowsBetween(Window.unboundedPreceding, 0)
    numbered = lined.withColumn("_session", F.last("_opens", ignorenulls=True).over(so_far)).where(F.col(START).isNotNull())
    return numbered.groupBy(*keys, F.col("_session").alias(START)).agg(
        F.max(END).alias(END), F.sum(EVENTS).alias(EVENTS), *[F.sum(s).cast(spans.schema[s].dataType).alias(s) for s in sums]
    )
