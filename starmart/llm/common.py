"""What the operators of this package share.

Column names that begin with two underscores are reserved for the operators; all other names may occur as extra columns.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = str(Path(__file__).resolve().parents[2])

# White space of the text contracts, as characters and as the inside of a regular-expression class.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    # Workers find this package where the driver does; on a cluster it is shipped with the job.
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])

    def run(batches):
        try:
            yield from work(batches)
        finally:
            # Workers wait for their next task, of whichever stage: without the memory that this one is done with.
            pa.default_memory_pool().release_unused()
            pa.system_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, for work that holds much for each row."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def strings(column: pa.Array) -> list[str]:
    """Texts of a column, null as empty."""
    return [text or "" for text in column.to_pylist()]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
