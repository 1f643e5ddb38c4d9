"""The two facts, each at its natural grain, carrying the conformed keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import surrogate_key
from ..operators import attach_key


def _own_key(natural: Column) -> Column:
    return F.when(natural.isNotNull(), surrogate_key(natural))


def fact_inpatient_charges(
    charges: DataFrame,
    dim_provider: DataFrame,
    dim_drg: DataFrame,
    dim_geography: DataFrame,
    own_dims: bool = False,
) -> DataFrame:
    """Hospital x diagnosis group, with the averages multiplied out so that they can be summed.

    ``own_dims`` says that the dimensions were built from these very ``charges``. Then every hospital and state
    has exactly one dimension row and its key is the hash of the natural key, so both keys are computed in place:
    the largest table is not shuffled to look up what it already knows. The diagnosis-group join stays, because a
    group with two descriptions has two dimension rows.
    """
    c = charges
    if own_dims:
        c = c.withColumns({"provider_sk": _own_key(c["ccn"]), "geo_sk": _own_key(c["provider_state"])})
    else:
        c = attach_key(c, dim_provider, ("ccn", "ccn"), "provider_sk")
        c = attach_key(c, dim_geography, ("provider_state", "state_code"), "geo_sk")
    c = attach_key(c, dim_drg, ("drg_code", "drg_code"), "drg_sk")
    return c.select(
        "ccn",
        "drg_code",
        "provider_sk",
        "drg_sk",
        "geo_sk",
        "total_discharges",
        "avg_covered_charge",
        "avg_total_payment",
        "avg_medicare_payment",
        "markup_ratio",
        "medicare_share",
        (F.col("avg_covered_charge") * F.col("total_discharges")).alias("wtd_covered_charge"),
        (F.col("avg_medicare_payment") * F.col("total_discharges")).alias("wtd_medicare_payment"),
    )


def fact_readmissions(readmissions: DataFrame, dim_provider: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Hospital x condition, without suppressed cells. A facility or state unknown to the charges has a null key."""
    r = readmissions.where(F.col("excess_readmission_ratio").isNotNull())
    r = attach_key(r, dim_provider, ("ccn", "ccn"), "provider_sk")
    r = attach_key(r, dim_geography, ("state", "state_code"), "geo_sk")
    return r.select(
        "ccn",
        "condition",
        "measure_raw",
        "provider_sk",
        "geo_sk",
        "discharges",
        "readmissions",
        "excess_readmission_ratio",
        "predicted_rate",
        "expected_rate",
    )
