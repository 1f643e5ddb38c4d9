"""Slowly changing attributes kept as versions (type 2) in a table that batches are merged into."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.history import FROM, HASH, TO, change_points
from ..operators.staged import stage
from .buckets import BucketTable


class History:
    """Versions of the attributes of keys, in one folder of Parquet files by buckets of keys.

    A version is a row: keys, attributes, ``valid_from``, ``valid_to`` (null while it holds) and ``row_hash``, the digest of its
    attributes by which changes are found. ``schema`` has the keys, the attributes and the time, in any order.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], time: str, buckets: int = 64
    ):
        self.keys, self.time = list(keys), time
        self.attributes = [f.name for f in schema if f.name not in (*keys, time)]
        fields = [T.StructField(name, schema[name].dataType) for name in (*self.keys, *self.attributes)]
        at = schema[time].dataType
        versions = [T.StructField(FROM, at), T.StructField(TO, at), T.StructField(HASH, T.StringType())]
        self.table = BucketTable(spark, path, T.StructType([*fields, *versions]), keys, buckets)

    def read(self) -> DataFrame:
        return self.table.read()

    def current(self) -> DataFrame:
        return self.read().where(F.col(TO).isNull()).drop(TO)

    def apply(self, batch: DataFrame, sequence: Sequence[str] = ()) -> int:
        """Merge observations (keys, attributes, time) and return how many buckets were written.

        An observation says what the attributes are from its time on. One that differs from the version which holds then begins a
        new version, up to the next one: at the end this opens a version and closes the one before, and a late one splits the
        version into which it falls. One that equals the version before it changes nothing. At a time that is known already the
        batch replaces the stored attributes; within the batch the greatest ``sequence`` holds. Rows without a time are left out.

        Only buckets with keys of the batch are read, and only those that come out different are written, so a batch that is
        applied again writes nothing.
        """
        fresh = batch.select(
            *self.keys,
            *self.attributes,
            F.col(self.time).alias(FROM),
            F.lit(1).alias("_new"),
            F.struct(F.lit(0).alias("_none"), *sequence).alias("_sequence"),
        )
        fresh = stage(fresh, "history-batch")
        old = self.table.touched_by(fresh)
        known = old.select(*self.keys, *self.attributes, FROM, F.lit(0).alias("_new"))
        points = fresh.unionByName(known, allowMissingColumns=True)
        merged = change_points(points, self.keys, self.attributes, ["_new", "_sequence"])
        return self.table.replace(old, stage(merged, "history-merged"))
