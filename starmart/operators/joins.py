"""Joins with dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_key(fact: DataFrame, dim: DataFrame, natural: tuple[str, str], key: str) -> DataFrame:
    """Left join that adds the dimension's ``key``; ``natural`` is the (fact, dimension) pair of natural-key columns.

    A row without a match keeps a null key; two dimension rows for one natural key double the fact row. No
    broadcast is forced: Spark takes it when the dimension's size on disk is under the threshold, and otherwise
    sorts and merges, splitting a hot key at run time.
    """
    fact_col, dim_col = natural
    keys = dim.select(F.col(dim_col).alias("_natural"), key)
    return fact.join(keys, fact[fact_col] == keys["_natural"], "left").drop("_natural")
