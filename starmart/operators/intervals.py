"""Pairs of overlapping intervals."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .slices import ticks
from .staged import stage

# Each level's bins are this many times as wide as those of the level below.
WIDER = 4
# Share of the intervals that fit the narrowest bins.
SHORT = 0.75


def overlapping_pairs(df: DataFrame, keys: Sequence[str], id_col: str, start: str, end: str) -> DataFrame:
    """Pairs of intervals of one key that share time: ``<id>_a``, ``<id>_b``, ``overlap_from``, ``overlap_to``.

    Intervals hold their start and not their end; those without a start or an end, or that end before they hold anything, overlap
    nothing. ``id_col`` tells rows apart; the smaller of a pair is a. Null keys are keys like others.

    Bins are as wide as most intervals are long; a longer interval belongs to a level of wider bins, so each lies in at most two bins of its
    level. At a level those that belong there meet each other and all shorter ones, in the bins they share, and a pair is reported
    only by the bin in which its overlap begins. So a key with very many intervals spans as many tasks as bins, long intervals do
    not flood the narrow bins, and no pair is formed that is apart by more than two bins of the longer one.
    """
    a, b = ticks(F.col(start)), ticks(F.col(end))
    named = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    bare = df.select(*named, F.col(id_col).alias("_id"), a.alias("_a"), b.alias("_b")).where("_a < _b")
    bare = stage(bare, "intervals")
    short, longest = bare.agg(
        F.percentile_approx(F.col("_b") - F.col("_a"), SHORT, 1000), F.max(F.col("_b") - F.col("_a"))
    ).first()
    width, longest = max(short or 1, 1), longest or 1
    levels = max(0, math.ceil(math.log(longest / width, WIDER))) + 1
    widths = [width * WIDER**level for level in range(levels)]
    own = F.coalesce(*[F.when(F.col("_b") - F.col("_a") <= w, F.lit(i)) for i, w in enumerate(widths)], F.lit(levels - 1))
    leveled = bare.withColumn("_own", own)
    width_at = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in widths]), F.col("_level") + 1)
    placed = leveled.withColumn("_level", F.explode(F.sequence("_own", F.lit(levels - 1))))
    # Whole numbers divided towards minus infinity, so bins before 1970 are as wide as those after.
    first, last = _bin(F.col("_a"), width_at), _bin(F.col("_b") - 1, width_at)
    binned = placed.withColumn("_bin", F.explode(F.sequence(first, last)))

    at = [f"_key{i}" for i in range(len(keys))] + ["_level", "_bin"]
    left = binned.where("_own = _level").select(*at, *[F.col(c).alias(f"{c}1") for c in ("_id", "_a", "_b")])
    right = binned.select(*at, *[F.col(c).alias(f"{c}2") for c in ("_id", "_a", "_b", "_own")])
    right = right.withColumnsRenamed({c: f"{c}_r" for c in at})
    meets = F.lit(True)
    for c in at:
        meets = meets & (F.col(c).eqNullSafe(F.col(f"{c}_r")) if c.startswith("_key") else F.col(c) == F.col(f"{c}_r"))
    begins = F.greatest("_a1", "_a2")
    shares = (F.col("_a1") < F.col("_b2")) & (F.col("_a2") < F.col("_b1"))
    # Two of one level meet twice, a shorter one only from the longer one's side.
    once = (F.col("_own2") < F.col("_level")) | (F.col("_id1") < F.col("_id2"))
    here = F.col("_bin") == _bin(begins, width_at)
    pairs = left.join(right, meets & shares & once & here)
    return pairs.select(
        *[F.col(f"_key{i}").alias(k) for i, k in enumerate(keys)],
        F.least("_id1", "_id2").alias(f"{id_col}_a"),
        F.greatest("_id1", "_id2").alias(f"{id_col}_b"),
        F.timestamp_micros(begins).alias("overlap_from"),
        F.timestamp_micros(F.least("_b1", "_b2")).alias("overlap_to"),
    )


def _bin(value, width):
    return ((value - F.pmod(value, width)) / width).cast("bigint")
