"""Raw extracts in the shape of the hospital sources, derived from the trial tables.

A supplier stands for a hospital, a part size for a diagnosis group, an order priority for a readmission measure and
a nation for a state. The trial tables are clean, so fixed rules over keys plant the dirt that the operators must
handle (lower-case states, zero payments, suppressed cells, unknown facilities). All rows of all tables are used.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import null_tokens
from ..operators import stage
from ..sources import INPATIENT_CHARGES, READMISSIONS

# The state of each nation key, and the commuting codes that hospitals cycle through.
STATES = [
    "CT", "NY", "PA", "VT", "IL", "OH", "MN", "MO", "TX", "FL", "DC", "GA", "VA",
    "CA", "WA", "HI", "CO", "PR", "GU", "TN", "MI", "NJ", "OR", "KY", "MA",
]
RUCA_CODES = ["1", "2", "3", "4.1", "6", "6.1", "10", "99", "abc"]

# The measure of each order priority.
MEASURES = {
    "1-URGENT": "READM-30-AMI-HRRP",
    "2-HIGH": "READM-30-HF-HRRP",
    "3-MEDIUM": "READM-30-PN-HRRP",
    "4-NOT SPECIFIED": "READM-30-COPD-HRRP",
    "5-LOW": "READM-30-HIP-KNEE-HRRP",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def padded(key: Column, width: int) -> Column:
    """Key as text with leading zeros; longer keys are kept whole."""
    text = key.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def _hundredths(column: str) -> Column:
    """An amount with two decimals, held as double, in whole hundredths."""
    return F.floor(F.col(column) * 100 + 0.5)


def _cents(total: Column, n: Column) -> Column:
    """``total / n`` to the cent, halves up."""
    cents = F.round((total * 100).cast("double") / n, 0)
    return (cents.cast("decimal(16,0)") * F.lit(Decimal("0.01"))).cast("decimal(14,2)")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey",
        F.concat(F.lit("ST. MARY'S "), F.upper("s_name"), F.lit("-WEST/EAST (MAIN)")).alias("org"),
        F.concat(F.lit("PORT "), F.upper("n_name")).alias("city"),
        "n_name",
        "s_nationkey",
        _pick(STATES, F.col("s_nationkey")).alias("state"),
    )


def raw_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hospital x diagnosis group: line items by supplier and part size, as averages per unit sold."""
    # Whole cents and hundredths: products are exact and stay in bigint, only the sums need more than 18 digits.
    charge = _hundredths("l_extendedprice")
    payment = charge * (100 - _hundredths("l_discount"))
    total = payment * (100 + _hundredths("l_tax"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("bigint").alias("quantity"),
        *[amount.cast("decimal(18,0)").alias(name) for name, amount in (("charge", charge), ("payment", payment), ("total", total))],
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    # Partial sums on the map side shrink a supplier's rows to one per part size and task before they move.
    groups = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_suppkey", "p_size")
        .agg(*[F.sum(c).alias(c) for c in ("quantity", "charge", "payment", "total")])
    )
    key, size, n = F.col("l_suppkey"), F.col("p_size"), F.col("quantity")
    # The payer covers 15 to 19 hundredths of the price, depending on the group.
    covered = ((size % 5 + 15) * F.lit(Decimal("0.01"))).cast("decimal(3,2)")
    charge, payment, total = (
        F.col(name).cast("decimal(26,0)") * F.lit(Decimal(unit))
        for name, unit in (("charge", "0.01"), ("payment", "0.0001"), ("total", "0.000001"))
    )
    code = padded((size - 1) * 18 + 2, 3)
    zero = F.lit(Decimal("0.00"))
    spot = key + size
    state = F.when(key % 2 == 0, F.lower("state")).otherwise(F.col("state"))
    values = {
        "Rndrng_Prvdr_CCN": padded(key, 6),
        "Rndrng_Prvdr_Org_Name": F.col("org"),
        "Rndrng_Prvdr_City": F.col("city"),
        "Rndrng_Prvdr_St": F.col("n_name"),
        "Rndrng_Prvdr_State_FIPS": padded(F.col("s_nationkey"), 2),
        "Rndrng_Prvdr_Zip5": padded(key * 37 % 100000, 5),
        "Rndrng_Prvdr_State_Abrvtn": state,
        "Rndrng_Prvdr_RUCA": _pick(RUCA_CODES, (key + size % 2) % len(RUCA_CODES)),
        "Rndrng_Prvdr_RUCA_Desc": F.lit(None).cast("string"),
        "DRG_Cd": code,
        "DRG_Desc": F.concat(F.lit("PROCEDURE GROUP "), code),
        "Tot_Dschrgs": n,
        "Avg_Submtd_Cvrd_Chrg": _cents(charge, n),
        "Avg_Tot_Pymt_Amt": F.when(spot % 89 == 7, zero).otherwise(_cents(total * covered, n)),
        "Avg_Mdcr_Pymt_Amt": F.when(spot % 97 == 5, zero).otherwise(_cents(payment * covered, n)),
    }
    named = groups.join(_suppliers(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
    return named.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in INPATIENT_CHARGES])


def _four_digits(top: Column, bottom: Column) -> Column:
    """Text of ``top / bottom`` with four decimals, halves up."""
    scaled = F.round(F.lit(10000.0) * top.cast("double") / bottom.cast("double"), 0)
    return (scaled.cast("decimal(18,0)") * F.lit(Decimal("0.0001"))).cast("decimal(18,4)").cast("string")


def landing_readmissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hospital x measure as it lands, all text: the share of returned lines against the share of all hospitals."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    groups = stage(
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_suppkey", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("l_returnflag") == "R", F.lit(1))).alias("returned")),
        "returns",
    )
    # Written, so that Spark sees the size of this summary before it chooses how to join it.
    everyone = stage(
        groups.groupBy("o_orderpriority").agg(F.sum("n").alias("all_n"), F.sum("returned").alias("all_returned")),
        "returns-all",
    )
    key, n, returned = F.col("l_suppkey"), F.col("n"), F.col("returned")
    all_n, all_returned = F.col("all_n"), F.col("all_returned")
    spot = (key * 7 + F.substring("o_orderpriority", 1, 1).cast("int")) % 11

    def cell(text: Column) -> Column:
        return (
            F.when(spot == 0, F.lit("N/A"))
            .when(spot == 1, F.lit("Not Available"))
            .when(spot == 2, F.lit(""))
            .otherwise(text)
        )

    measure = F.col("o_orderpriority")
    for priority, name in MEASURES.items():
        measure = F.when(F.col("o_orderpriority") == priority, F.lit(name)).otherwise(measure)
    values = {
        "Facility_Name": F.col("org"),
        "Facility_ID": F.concat(F.when(key % 13 == 5, F.lit("H")).otherwise(F.lit("")), padded(key, 6)),
        "State": F.when(key % 17 == 3, F.lit("WY")).otherwise(F.col("state")),
        "Measure_Name": measure,
        "Number_of_Discharges": cell(n.cast("string")),
        "Footnote": F.lit(None).cast("string"),
        "Excess_Readmission_Ratio": cell(
            _four_digits(returned.cast("double") * all_n.cast("double"), n.cast("double") * all_returned.cast("double"))
        ),
        "Predicted_Readmission_Rate": cell(_four_digits(returned * 100, n)),
        "Expected_Readmission_Rate": cell(_four_digits(all_returned * 100, all_n)),
        "Number_of_Readmissions": cell(returned.cast("string")),
        "Start_Date": F.lit("07/01/2021"),
        "End_Date": F.lit("06/30/2024"),
    }
    named = groups.join(everyone, "o_orderpriority").join(
        _suppliers(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey")
    )
    return named.select(*[values[f.name].alias(f.name) for f in READMISSIONS])


def loaded_readmissions(landed: DataFrame) -> DataFrame:
    """The landed rows after loading: cells that mean "no value" are null."""
    return landed.select(*[null_tokens(F.col(f.name)).alias(f.name) for f in READMISSIONS])
