"""A raw table that takes published releases one by one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .landing import LOADED, REASON, RECORD, REJECTED, STATUS, coerce, read_landing

RELEASE = "release"
_LEDGER = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("rows", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField(RELEASE, T.StringType()),
    ]
)


@dataclass(frozen=True)
class ReleaseLoad:
    """What loading a release did: whether anything was written, and the rows and rejected rows of the release."""

    written: bool
    rows: int
    rejected: int


class ReleaseTable:
    """Rows of all releases in one folder, a partition each, beside a ledger of the files that were loaded.

    A release whose files are in the ledger, with the size and time they had, is not read again. Any other difference (a new file, a
    file gone, one that was corrected) replaces the whole release and leaves the others alone. The ledger is written after the rows: a
    load that was cut off in between is done again, with the same outcome.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        text = T.StringType()
        extra = [T.StructField(name, text) for name in (STATUS, REASON, RECORD, RELEASE)]
        self.spark, self.source = spark, schema
        self.schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in schema], *extra])
        self.rows_path, self.ledger_path = f"{path.rstrip('/')}/rows", f"{path.rstrip('/')}/ledger"
        for where, columns in ((self.rows_path, self.schema), (self.ledger_path, _LEDGER)):
            spark.createDataFrame([], columns).write.mode("ignore").partitionBy(RELEASE).parquet(where)

    def ledger(self) -> DataFrame:
        return self.spark.read.schema(_LEDGER).parquet(self.ledger_path)

    def _written(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.rows_path)

    def read(self) -> DataFrame:
        """The good rows of all releases, with ``release``."""
        return self._written().where(F.col(STATUS) == LOADED).select(*self.source.fieldNames(), RELEASE)

    def rejects(self) -> DataFrame:
        return self._written().where(F.col(STATUS) == REJECTED).select(RELEASE, RECORD, REASON)

    def load(self, release: str, folder: str, multi_line: bool = True) -> ReleaseLoad:
        """Load the CSV files of ``folder`` as ``release``, unless the ledger has all of them as they are."""
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.csv*").load(folder)
        # Only names, sizes and times are read, not the contents.
        found = {
            (r.file, r.bytes, r.modified)
            for r in listed.select(
                F.element_at(F.split("path", "/"), -1).alias("file"),
                F.col("length").alias("bytes"),
                F.col("modificationTime").alias("modified"),
            ).collect()  # one row per file of a release
        }
        if not found:
            raise FileNotFoundError(f"no CSV files in {folder}")
        known = self.ledger().where(F.col(RELEASE) == release).collect()
        if found == {(r.file, r.bytes, r.modified) for r in known}:
            return ReleaseLoad(False, known[0].rows, known[0].rejected)

        counts = Observation()
        checked = coerce(read_landing(self.spark, folder, multi_line=multi_line), self.source)
        checked = checked.withColumn(RELEASE, F.lit(release)).observe(
            counts,
            F.count(F.when(F.col(STATUS) == LOADED, F.lit(1))).alias("rows"),
            F.count(F.when(F.col(STATUS) != LOADED, F.lit(1))).alias("rejected"),
        )
        self._overwrite(checked.select(*self.schema.fieldNames()), self.rows_path)
        rows, rejected = counts.get["rows"], counts.get["rejected"]
        if not rows + rejected:
            raise ValueError(f"release {release} has no rows in {folder}; what was loaded of it before stays")
        lines = [(file, size, modified, rows, rejected, None, release) for file, size, modified in sorted(found)]
        entry = self.spark.createDataFrame(lines, _LEDGER).withColumn("loaded_at", F.current_timestamp())
        self._overwrite(entry.coalesce(1), self.ledger_path)
        return ReleaseLoad(True, rows, rejected)

    @staticmethod
    def _overwrite(df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RELEASE).parquet(path)
