"""Conformed dimensions, rebuilt in full from the charges staging (no history is kept).

``hospitals`` may be the charges staging itself or, cheaper, its distinct hospital columns (``stg_hospitals``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    in_list,
    label_by_member,
    label_by_range,
    label_by_threshold,
    surrogate_key,
    try_float,
    try_number,
)
from .lookups import CENSUS_REGIONS, COMMON_CODES, OTHER, RURAL, SERVICE_LINES, URBANICITY


def dim_provider(hospitals: DataFrame) -> DataFrame:
    """One row per hospital. Each attribute is the greatest text seen for it, on its own."""
    attributes = ["provider_name", "provider_city", "provider_state", "provider_zip", "ruca_code"]
    merged = hospitals.groupBy("ccn").agg(*[F.max(a).alias(a) for a in attributes])
    return merged.withColumn("ruca", try_float(F.col("ruca_code"))).select(
        surrogate_key(F.col("ccn")).alias("provider_sk"),
        "ccn",
        "provider_name",
        "provider_city",
        "provider_state",
        "provider_zip",
        label_by_threshold(F.col("ruca"), URBANICITY, RURAL).alias("urbanicity"),
    )


def dim_drg(charges: DataFrame) -> DataFrame:
    """One row per diagnosis group and description; a group with two descriptions fails the uniqueness check."""
    groups = charges.select("drg_code", "drg_desc").distinct()
    # The number is its own column, so that it is parsed once and not once per range.
    return groups.withColumn("number", try_number(F.col("drg_code"))).select(
        surrogate_key(F.col("drg_code")).alias("drg_sk"),
        "drg_code",
        "drg_desc",
        label_by_range(F.col("number"), SERVICE_LINES, OTHER).alias("service_line"),
        in_list(F.col("drg_code"), COMMON_CODES).alias("is_common_drg"),
    )


def dim_geography(hospitals: DataFrame) -> DataFrame:
    """One row per state of the charges."""
    states = hospitals.select(F.col("provider_state").alias("state_code")).where("state_code IS NOT NULL").distinct()
    return states.select(
        surrogate_key(F.col("state_code")).alias("geo_sk"),
        "state_code",
        label_by_member(F.col("state_code"), CENSUS_REGIONS, OTHER).alias("census_region"),
    )
