"""Sessions kept as a table that batches of events are merged into."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sessions import END, EVENTS, START, sessions
from ..operators.staged import stage
from .buckets import BucketTable


class SessionTable:
    """Sessions of all events so far, by buckets of keys.

    ``schema`` has the columns of the events: the keys, the time and the sums to keep.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        time: str,
        gap: timedelta,
        sums: Sequence[str] = (),
        buckets: int = 64,
    ):
        self.keys, self.time, self.gap, self.sums = list(keys), time, gap, list(sums)
        at = schema[time].dataType
        fields = [T.StructField(k, schema[k].dataType) for k in keys]
        fields += [T.StructField(START, at), T.StructField(END, at), T.StructField(EVENTS, T.LongType())]
        fields += [T.StructField(s, schema[s].dataType) for s in sums]
        self.table = BucketTable(spark, path, T.StructType(fields), keys, buckets)

    def read(self) -> DataFrame:
        return self.table.read()

    def apply(self, batch: DataFrame) -> int:
        """Add the events of a batch, each once, and return how many buckets were written.

        Events may come in any order. A late one opens a session of its own, makes one longer, or joins the two between which it falls;
        what comes out is what one pass over all events would give. An event that is delivered twice counts twice.
        """
        at = F.col(self.time)
        events = batch.where(at.isNotNull()).select(
            *self.keys, at.alias(START), at.alias(END), F.lit(1).cast("long").alias(EVENTS), *self.sums
        )
        events = stage(events, "session-events")
        old = self.table.touched_by(events)
        merged = sessions(old.select(events.columns).unionByName(events), self.keys, self.gap, self.sums)
        return self.table.replace(old, stage(merged, "sessions"))
