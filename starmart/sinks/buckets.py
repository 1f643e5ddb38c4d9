"""Tables that batches are merged into, kept by buckets of keys so that a batch rewrites only what it touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "key_bucket"


class BucketTable:
    """One folder of Parquet files, a sub-folder for each bucket of keys."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.schema = T.StructType([*schema, T.StructField(BUCKET, T.IntegerType())])
        # Makes the folder; an existing one stays as it is.
        spark.createDataFrame([], self.schema).write.mode("ignore").partitionBy(BUCKET).parquet(self.path)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def stored(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def read(self) -> DataFrame:
        return self.stored().drop(BUCKET)

    def touched_by(self, batch: DataFrame) -> DataFrame:
        """The stored rows of all buckets that hold a key of ``batch``; no other file is read."""
        touched = [r[0] for r in batch.select(self.bucket()).distinct().collect()]  # at most one row per bucket
        return self.stored().where(F.col(BUCKET).isin(touched))

    def replace(self, old: DataFrame, new: DataFrame) -> int:
        """Write the buckets in which ``new`` (a written table) differs from ``old``; returns how many.

        Each is replaced as a whole, so a run that was cut off can be repeated.
        """
        new = new.withColumn(BUCKET, self.bucket())
        before, after = self._digests(old), self._digests(new)
        changed = after.exceptAll(before).select(BUCKET).distinct().collect()  # at most one row per bucket
        if changed:
            rows = new.where(F.col(BUCKET).isin([r[0] for r in changed])).select(*self.schema.fieldNames())
            # Files follow the size of a bucket, not the number of tasks; a large bucket is split.
            dealt = self.spark.sql(f"SELECT /*+ REBALANCE({BUCKET}) */ * FROM {{rows}}", rows=rows)
            writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(BUCKET).parquet(self.path)
        return len(changed)

    def _digests(self, rows: DataFrame) -> DataFrame:
        """Number of rows and an order-free digest of each bucket."""
        row = F.to_json(F.struct(*[f.name for f in self.schema if f.name != BUCKET]))
        return rows.groupBy(BUCKET).agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(row)).alias("a"), F.sum(F.crc32(row)).alias("b")
        )
