"""Sums at several levels of detail from one summed base."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVEL = "level"


def sum_lattice(base: DataFrame, levels: Sequence[Sequence[str]], sums: Sequence[str]) -> DataFrame:
    """``sums`` at each of ``levels`` (lists of columns), with ``level``, the columns kept, joined by `` x `` (``all`` for none).

    ``base`` should already be summed to the finest level: each of its rows is read once and counts once per level. A column is null where
    its level leaves it out, which ``level`` tells from a value that is not known.
    """
    columns = list(dict.fromkeys(c for level in levels for c in level))
    kept = [F.when(F.grouping(c) == 0, F.lit(c)) for c in columns]
    name = F.concat_ws(" x ", *kept)
    grouped = base.groupingSets([[F.col(c) for c in level] for level in levels], *columns)
    rolled = grouped.agg(name.alias(LEVEL), *[F.sum(s).alias(s) for s in sums])
    return rolled.withColumn(LEVEL, F.when(F.col(LEVEL) == "", "all").otherwise(F.col(LEVEL)))
