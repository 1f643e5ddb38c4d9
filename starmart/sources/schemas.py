"""Raw tables as Spark schemas. Column names are fixed values: they are those of the published extracts."""

from pyspark.sql import types as T

_TEXT, _COUNT, _MONEY = T.StringType(), T.LongType(), T.DecimalType(14, 2)

# One row per hospital and diagnosis group.
INPATIENT_CHARGES = T.StructType(
    [
        T.StructField("Rndrng_Prvdr_CCN", _TEXT, nullable=False),
        T.StructField("Rndrng_Prvdr_Org_Name", _TEXT),
        T.StructField("Rndrng_Prvdr_City", _TEXT),
        T.StructField("Rndrng_Prvdr_St", _TEXT),
        T.StructField("Rndrng_Prvdr_State_FIPS", _TEXT),
        T.StructField("Rndrng_Prvdr_Zip5", _TEXT),
        T.StructField("Rndrng_Prvdr_State_Abrvtn", _TEXT),
        T.StructField("Rndrng_Prvdr_RUCA", _TEXT),
        T.StructField("Rndrng_Prvdr_RUCA_Desc", _TEXT),
        T.StructField("DRG_Cd", _TEXT, nullable=False),
        T.StructField("DRG_Desc", _TEXT),
        T.StructField("Tot_Dschrgs", _COUNT),
        T.StructField("Avg_Submtd_Cvrd_Chrg", _MONEY),
        T.StructField("Avg_Tot_Pymt_Amt", _MONEY),
        T.StructField("Avg_Mdcr_Pymt_Amt", _MONEY),
    ]
)

# One row per facility and readmission measure; everything is text, numbers are cast in staging.
READMISSIONS = T.StructType(
    [
        T.StructField("Facility_Name", _TEXT),
        T.StructField("Facility_ID", _TEXT, nullable=False),
        T.StructField("State", _TEXT),
        T.StructField("Measure_Name", _TEXT),
        T.StructField("Number_of_Discharges", _TEXT),
        T.StructField("Footnote", _TEXT),
        T.StructField("Excess_Readmission_Ratio", _TEXT),
        T.StructField("Predicted_Readmission_Rate", _TEXT),
        T.StructField("Expected_Readmission_Rate", _TEXT),
        T.StructField("Number_of_Readmissions", _TEXT),
        T.StructField("Start_Date", _TEXT),
        T.StructField("End_Date", _TEXT),
    ]
)
