"""What changed from one release of a table to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ADDED, REMOVED, CHANGED = "added", "removed", "changed"


def bag_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that ``new`` has more or fewer times than ``old``, each once, with ``_copies``, the signed difference.

    Both sides are put together with a sign and summed by the whole row, so there is one shuffle, repeated rows are one per task before
    it, and nulls equal nulls. Columns are matched by name.
    """
    signed = old.withColumn("_sign", F.lit(-1)).unionByName(new.withColumn("_sign", F.lit(1)))
    counted = signed.groupBy(*old.columns).agg(F.sum("_sign").alias("_copies"))
    return counted.where(F.col("_copies") != 0)


def release_difference(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with a difference: ``change``, ``n_removed`` and ``n_added`` rows, and ``changed_columns``.

    A key that lost and gained rows is changed; ``changed_columns`` names, in order of the columns and joined by commas, those whose
    values differ between its removed and added rows as bags (all of them, where it lost more rows than it gained or fewer), and is null
    for other changes. Values are compared by sums of
    digests over the differing rows, which add up in parts, so a key with very many rows is never gathered.
    """
    others = [c for c in old.columns if c not in keys]
    differing = bag_difference(old, new)
    copies = F.col("_copies")
    # Two independent digests: a wrong match would need both sums to agree by chance.
    sums = []
    for i, column in enumerate(others):
        cell = F.to_json(F.struct(column))
        for digest, name in ((F.xxhash64(cell), "x"), (F.hash(cell), "h")):
            sums.append(F.sum(copies.cast("decimal(18,0)") * digest.cast("decimal(20,0)")).alias(f"_{name}{i}"))
    per_key = differing.groupBy(*keys).agg(
        F.sum(F.when(copies < 0, -copies).otherwise(0)).alias("n_removed"),
        F.sum(F.when(copies > 0, copies).otherwise(0)).alias("n_added"),
        *sums,
    )
    both = (F.col("n_removed") > 0) & (F.col("n_added") > 0)
    names = [F.when((F.col(f"_x{i}") != 0) | (F.col(f"_h{i}") != 0), F.lit(c)) for i, c in enumerate(others)]
    moved = F.when(both, F.concat_ws(",", *names) if names else F.lit(""))
    change = F.when(both, F.lit(CHANGED)).when(F.col("n_added") > 0, F.lit(ADDED)).otherwise(F.lit(REMOVED))
    return per_key.select(*keys, change.alias("change"), "n_removed", "n_added", moved.alias("changed_columns"))
