"""Exact equal-count buckets and percentiles, by one road at every size.

Spark's ``ntile`` over an unpartitioned window sorts the whole input in one task, and ``percentile`` keeps every distinct value
of a group in one buffer. Here all rows are sorted by range across the cluster instead (``rank_rows``), which splits a hot
group, and a hot value, by the key; what is asked for then follows from positions. Neither the plan nor its
cost depends on the number of buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranks import rank_rows
from .staged import stage


def exact_ntile(df: DataFrame, buckets: int, value: str, key: Sequence[str], name: str) -> DataFrame:
    """``ntile(buckets)`` over the whole frame by a value of any type that sorts and then the key, nulls last.

    Rows that the key does not tell apart are put on either side of a border by chance. ``df`` is read several times, so
    ``stage`` it first when it is costly to compute.
    """
    ranked = rank_rows(df, [F.col(c).asc_nulls_last() for c in (value, *key)])
    small, extra = F.expr(f"_total div {buckets}"), F.col("_total") % buckets
    in_large = extra * (small + 1)
    bucket = F.when(
        F.col("_position") < in_large, F.floor(F.col("_position") / (small + 1)) + 1
    ).otherwise(extra + F.floor((F.col("_position") - in_large) / F.greatest(small, F.lit(1))) + 1)
    return ranked.withColumn("_bucket", bucket.cast("bigint")).select(*df.columns, F.col("_bucket").alias(name))


def exact_percentiles(
    df: DataFrame, value: str, percentages: Mapping[str, float], by: Sequence[str] = (), key: Sequence[str] = ()
) -> DataFrame:
    """Exact interpolated percentiles of a numeric column, per group: ``by`` columns, ``n`` and one double per percentage.

    Null values are left out. ``key`` names columns that tell rows of equal value apart; it lets a value that fills
    much of a group spread over several partitions and does not change the result.
    """
    if not isinstance(df.schema[value].dataType, T.NumericType):
        raise TypeError(f"percentiles need a numeric column, {value} is {df.schema[value].dataType.simpleString()}")
    known = df.where(F.col(value).isNotNull()).select(*by, *key, F.col(value).cast("double").alias("_value"))
    ranked = rank_rows(known, [F.col(c).asc_nulls_last() for c in (*by, "_value", *key)], [*by, "_value"])

    # A group's rows are neighbours, so its first position and its size tell where each wanted row is.
    spans = ranked.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("_position").alias("_first"))
    ranks = {name: F.lit(p) * (F.col("_n") - 1) for name, p in percentages.items()}
    wanted = [near(rank) for rank in ranks.values() for near in (F.floor, F.ceil)]
    lines = [
        F.struct(F.lit(i).alias("_i"), (F.col("_first") + at).cast("bigint").alias("_position"))
        for i, at in enumerate(wanted)
    ]
    # Two rows for each group and percentage, written: Spark sees their size and sends them to the ranked rows if it is small.
    targets = stage(spans.select("_n", F.inline(F.array(*lines))), "targets")
    found = ranked.join(targets, "_position")

    def neighbour(i: int):
        return F.max(F.when(F.col("_i") == i, F.col("_value")))

    sides = [neighbour(i).alias(f"_v{i}") for i in range(len(wanted))]
    grouped = found.groupBy(*by).agg(F.coalesce(F.max("_n"), F.lit(0)).alias("_n"), *sides)
    columns = []
    for j, (name, rank) in enumerate(ranks.items()):
        low, high, share = F.col(f"_v{2 * j}"), F.col(f"_v{2 * j + 1}"), rank - F.floor(rank)
        # The lower neighbour alone where nothing of the other is asked: 0 * Infinity is no number.
        exact = (share == 0) | (low == high)
        columns.append(F.when(exact, low).otherwise((1 - share) * low + share * high).alias(name))
    return grouped.select(*by, F.col("_n").alias("n"), *columns)
