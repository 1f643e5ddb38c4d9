"""Change points of attributes over time, and versions that hold from one to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .slices import handed_on, slice_of, spread
from .staged import stage

FROM, TO, HASH = "valid_from", "valid_to", "row_hash"


def row_hash(columns: Sequence[str]) -> Column:
    """32-character hex digest of the named values; nulls and separators inside texts cannot make two rows alike."""
    return F.md5(F.to_json(F.struct(*columns)).cast("binary"))


def change_points(points: DataFrame, keys: Sequence[str], attributes: Sequence[str], rank: Sequence[str]) -> DataFrame:
    """Rows of ``points`` at which the attributes of a key change: keys, attributes, ``valid_from``, ``valid_to``, ``row_hash``.

    Of the rows of one key and time that with the greatest ``rank`` holds, then the greatest attributes, whatever their
    order. ``valid_to`` is the next change of the key, null for the last. Null keys are keys like others; rows
    without a time are left out.
    """
    held = (
        points.where(F.col(FROM).isNotNull())
        .groupBy(*keys, FROM)
        .agg(F.max_by(F.struct(*attributes), F.struct(*rank, *attributes)).alias("_held"))
        .select(*keys, FROM, "_held.*")
        .withColumn(HASH, row_hash(attributes))
    )
    held = stage(held, "history-points")
    rows = held.count()
    held = held.withColumn("_slice", slice_of(held, F.col(FROM), rows))
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(F.asc_nulls_first(FROM))

    # The last row of the slices before stands first in its slice, without a time.
    last = spread(held, rows, *keys, "_slice").groupBy(*keys, "_slice").agg(F.max_by(HASH, FROM).alias(HASH))
    begins = handed_on(spread(last, rows, *keys), keys, "_slice", HASH)
    lined = spread(held.unionByName(begins, allowMissingColumns=True), rows, *keys, "_slice")
    changed = lined.withColumn("_earlier", F.lag(HASH).over(in_slice)).where(~F.col(HASH).eqNullSafe(F.col("_earlier")))
    changed = changed.where(F.col(FROM).isNotNull()).drop("_earlier")
    changed = stage(changed, "history-changes")

    # The first change of the slices after stands last in its slice, without a digest.
    first = spread(changed, rows, *keys, "_slice").groupBy(*keys, "_slice").agg(F.min(FROM).alias(FROM))
    ends = handed_on(spread(first, rows, *keys), keys, "_slice", FROM, forward=False)
    lined = spread(changed.unionByName(ends, allowMissingColumns=True), rows, *keys, "_slice")
    closed = lined.withColumn(TO, F.lead(FROM).over(in_slice)).where(F.col(HASH).isNotNull())
    return closed.select(*keys, *attributes, FROM, TO, HASH)
