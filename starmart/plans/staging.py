"""Staging: readable names, types and the two ratios. Lazy projections of the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import guarded_ratio, map_values, title_case, try_float, try_number
from .lookups import CONDITIONS


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(14,2)")


def _paid(raw: DataFrame) -> DataFrame:
    return raw.where(_money("Avg_Mdcr_Pymt_Amt") > 0)


def _hospital_columns() -> list[Column]:
    return [
        F.col("Rndrng_Prvdr_CCN").alias("ccn"),
        title_case(F.col("Rndrng_Prvdr_Org_Name")).alias("provider_name"),
        title_case(F.col("Rndrng_Prvdr_City")).alias("provider_city"),
        F.upper("Rndrng_Prvdr_State_Abrvtn").alias("provider_state"),
        F.col("Rndrng_Prvdr_Zip5").alias("provider_zip"),
        F.col("Rndrng_Prvdr_RUCA").alias("ruca_code"),
    ]


def stg_hospitals(raw: DataFrame) -> DataFrame:
    """The hospital columns of the charges staging, without repeats: what the provider and geography dimensions read.

    Repeats go before the text is cleaned, in a hash aggregate that starts on the map side, so that cleaning and the
    sort that a greatest-text aggregate needs work on a few rows per hospital instead of one per charge.
    """
    source = [
        "Rndrng_Prvdr_CCN",
        "Rndrng_Prvdr_Org_Name",
        "Rndrng_Prvdr_City",
        "Rndrng_Prvdr_State_Abrvtn",
        "Rndrng_Prvdr_Zip5",
        "Rndrng_Prvdr_RUCA",
    ]
    return _paid(raw).select(*source).distinct().select(*_hospital_columns())


def stg_inpatient_charges(raw: DataFrame) -> DataFrame:
    """Charges with a positive payment; the casts are strict, so a bad value stops the build."""
    charge, total, payment = (_money(c) for c in ("Avg_Submtd_Cvrd_Chrg", "Avg_Tot_Pymt_Amt", "Avg_Mdcr_Pymt_Amt"))
    return _paid(raw).select(
        *_hospital_columns(),
        F.col("DRG_Cd").alias("drg_code"),
        F.col("DRG_Desc").alias("drg_desc"),
        F.col("Tot_Dschrgs").cast("bigint").alias("total_discharges"),
        charge.alias("avg_covered_charge"),
        total.alias("avg_total_payment"),
        payment.alias("avg_medicare_payment"),
        guarded_ratio(charge, payment, 2).alias("markup_ratio"),
        guarded_ratio(payment, total, 3).alias("medicare_share"),
    )


def stg_readmissions(raw: DataFrame) -> DataFrame:
    """Readmissions of known facilities; suppressed cells become null."""
    return raw.where(F.col("Facility_ID").isNotNull()).select(
        F.col("Facility_ID").alias("ccn"),
        title_case(F.col("Facility_Name")).alias("facility_name"),
        F.upper("State").alias("state"),
        F.col("Measure_Name").alias("measure_raw"),
        map_values(F.col("Measure_Name"), CONDITIONS).alias("condition"),
        try_number(F.col("Number_of_Discharges")).alias("discharges"),
        try_float(F.col("Excess_Readmission_Ratio")).alias("excess_readmission_ratio"),
        try_float(F.col("Predicted_Readmission_Rate")).alias("predicted_rate"),
        try_float(F.col("Expected_Readmission_Rate")).alias("expected_rate"),
        try_number(F.col("Number_of_Readmissions")).alias("readmissions"),
    )
