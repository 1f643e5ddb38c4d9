"""Lookup of the version that held when a fact happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .history import FROM, TO
from .slices import handed_on, slice_of, spread


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    valid_from: str = FROM,
    valid_to: str | None = TO,
    rows: int | None = None,
) -> DataFrame:
    """``facts`` with the ``values`` of their key's version that holds at ``time``: the last one that begins no later.

    No range join: facts and versions are put together, sorted by time within key and time slice, and the last version is carried
    forward; the one that holds when a slice begins is put first in it. So facts move once, and a key with a third of them spans as
    many tasks as there are slices; tasks follow the facts' number, ``rows``, which is counted if it is not given. Every fact stays as often as it occurs; its values are null without a version, without
    a time, or after the version's ``valid_to`` (exclusive; null: open). Null keys match null keys. Of versions that begin
    together the greatest counts. Values must not be named like columns of ``facts``.
    """
    clash = set(values) & set(facts.columns)
    if clash:
        raise ValueError(f"facts already have {', '.join(sorted(clash))}")
    ends = F.col(valid_to) if valid_to is not None else F.lit(None).cast(versions.schema[valid_from].dataType)
    kind = facts.schema[time].dataType
    rows = facts.count() if rows is None else rows
    known = spread(versions.where(F.col(valid_from).isNotNull()), rows, *keys, valid_from).groupBy(*keys, valid_from)
    known = known.agg(F.max(F.struct(ends.alias("_ends"), *values)).alias("_version"))
    known = known.select(*keys, F.col(valid_from).cast(kind).alias("_time"), F.lit(0).alias("_side"), "_version")
    happened = facts.select(*keys, F.col(time).alias("_time"), F.lit(1).alias("_side"), F.struct(*facts.columns).alias("_fact"))
    # Slices follow the times of the facts, the larger side.
    number = slice_of(happened, F.col("_time"), rows)

    light = happened.drop("_fact").unionByName(known, allowMissingColumns=True).withColumn("_slice", number)
    last = spread(light, rows, *keys, "_slice").groupBy(*keys, "_slice").agg(
        F.max_by("_version", F.when(F.col("_side") == 0, F.col("_time"))).alias("_version")
    )
    begins = handed_on(spread(last, rows, *keys), keys, "_slice", "_version").withColumn("_side", F.lit(-1))
    both = happened.unionByName(known, allowMissingColumns=True).withColumn("_slice", number)
    lined = spread(both.unionByName(begins, allowMissingColumns=True), rows, *keys, "_slice")

    order = [F.col("_side") >= 0, F.asc_nulls_first("_time"), F.col("_side")]
    so_far = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = lined.withColumn("_held", F.last("_version", ignorenulls=True).over(so_far)).where("_side = 1")
    ends = F.col("_held")["_ends"]
    holds = F.col("_time").isNotNull() & (ends.isNull() | (F.col("_time") < ends))
    return found.select("_fact.*", *[F.when(holds, F.col("_held")[v]).alias(v) for v in values])
