"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a null part and the gap between parts contribute to the hashed text. Keys must agree with
# those of already published marts, so both are part of the key's definition.
NULL_PART = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*parts: Column) -> Column:
    """32-character hex key of the natural key; equal in every table and every run, so no lookup is needed to make it."""
    texts = [F.coalesce(part.cast("string"), F.lit(NULL_PART)) for part in parts]
    return F.md5(F.concat_ws(SEPARATOR, *texts))
