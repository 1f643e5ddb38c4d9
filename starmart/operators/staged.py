"""Written intermediate tables.

A frame that several jobs read is written once as Parquet in the cluster's shared checkpoint folder. It then
survives lost executors, is not computed again by each reader, and has a real size on disk, so Spark's own
``spark.sql.autoBroadcastJoinThreshold`` decides from facts whether to broadcast it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for a local master that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="starmart-")
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder.

    All paths of an application lie in ``starmart/<application id>``, to be removed when it has ended.
    """
    return f"{shared_dir(spark)}/starmart/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def cleanup(spark: SparkSession) -> None:
    """Remove all that this application has staged. Frames that read staged tables can't be used afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{shared_dir(spark)}/starmart/{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh shared folder and return a reader of it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
