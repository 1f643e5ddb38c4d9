"""Global positions of sorted rows without one task that sees them all.

Rows are sorted by range across the cluster; a row's position is its place in its partition plus the sizes of the
partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staged import stage

# Fewest and most rows that one range partition should hold; in between, the session's number of partitions holds.
LEAST_PARTITION_ROWS = 10_000
PARTITION_ROWS = 10_000_000

# Layout of monotonically_increasing_id(): partition number above 33 bits of position within the partition.
_POSITION_BITS = 33


def rank_rows(
    df: DataFrame, order: Sequence[Column], keep: Sequence[str] | None = None, rows: int | None = None
) -> DataFrame:
    """Add ``_position`` (from 0, in ``order``) and ``_total`` (number of rows).

    ``order`` should end in a key, so that equal values can be split over partitions and ties are stable. Columns
    needed only for the order can be left out of the result, and so out of what is written, with ``keep``. ``rows``
    is the number of rows, if known.
    """
    rows = df.count() if rows is None else rows
    session_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(min(session_parts, rows // LEAST_PARTITION_ROWS), rows // PARTITION_ROWS, 1)
    ordered = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    columns = df.columns if keep is None else keep
    placed = stage(ordered.select(*columns, F.monotonically_increasing_id().alias("_place")), "ranked")
    part = F.shiftright("_place", _POSITION_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range partition, so a few bytes for every PARTITION_ROWS rows of data.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy()).alias("_total"),
    )
    within = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn("_position", F.col("_before") + within)
        .drop("_part", "_place", "_before")
    )
