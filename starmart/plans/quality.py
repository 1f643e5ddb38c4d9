"""The declared checks of the star."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..operators import check_columns, check_grain, check_relationships, check_unique
from .lookups import CENSUS_REGIONS, CONDITIONS, OTHER


def star_checks(star: Mapping[str, DataFrame]) -> list[DataFrame]:
    """The 19 checks of the five mart tables."""
    provider, drg, geography = star["dim_provider"], star["dim_drg"], star["dim_geography"]
    charges, readmissions = star["fact_inpatient_charges"], star["fact_readmissions"]
    return [
        check_unique(provider, "dim_provider", ["provider_sk", "ccn"]),
        check_columns(provider, "dim_provider", not_null=["provider_sk", "ccn"]),
        check_unique(drg, "dim_drg", ["drg_sk", "drg_code"]),
        check_columns(drg, "dim_drg", not_null=["drg_sk", "drg_code", "service_line"]),
        check_unique(geography, "dim_geography", ["geo_sk"]),
        check_columns(
            geography,
            "dim_geography",
            not_null=["geo_sk"],
            accepted_values={"census_region": [*CENSUS_REGIONS, OTHER]},
        ),
        check_columns(
            charges,
            "fact_inpatient_charges",
            not_null=["provider_sk"],
            accepted_range={"avg_medicare_payment": (0, None)},
        ),
        check_relationships(charges, "fact_inpatient_charges", "provider_sk", provider, "provider_sk"),
        check_relationships(charges, "fact_inpatient_charges", "drg_sk", drg, "drg_sk"),
        check_columns(
            readmissions,
            "fact_readmissions",
            accepted_values={"condition": list(CONDITIONS.values())},
            accepted_range={"excess_readmission_ratio": (0, None)},
        ),
        check_relationships(readmissions, "fact_readmissions", "provider_sk", provider, "provider_sk"),
    ]


def strict_checks(star: Mapping[str, DataFrame]) -> list[DataFrame]:
    """What the 19 cannot see: facilities without a provider (their key is null, which passes), and the fact grains."""
    charges, readmissions = star["fact_inpatient_charges"], star["fact_readmissions"]
    return [
        check_relationships(
            readmissions, "fact_readmissions", "provider_sk", star["dim_provider"], "provider_sk", strict=True
        ),
        check_grain(charges, "fact_inpatient_charges", ["ccn", "drg_code"]),
        check_grain(readmissions, "fact_readmissions", ["ccn", "measure_raw"]),
    ]
