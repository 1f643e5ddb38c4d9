"""The analyst questions.

Roll-ups weight the per-discharge averages by discharges; a plain mean of them would be wrong. Each fact is summed
to its key before it is joined, so a join moves one row per key, not the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import guarded_ratio, ratio_of_sums, round_stable, safe_corr
from ..operators import exact_ntile, exact_percentiles, leaders_per_group, stage, sum_lattice


def price_variation(
    charges: DataFrame,
    dim_drg: DataFrame,
    dim_provider: DataFrame,
    drg_code: str = "470",
) -> DataFrame:
    """Spread of the average charge, and of the payment, over the hospitals of one diagnosis group. One row."""
    # The dimension is a written table: its size decides whether Spark sends it to the fact, and else a hot key is split.
    group = dim_drg.where(F.col("drg_code") == drg_code).select("drg_sk")
    # Equal keys mean equal codes: the repeated filter lets the scan of the fact skip other groups.
    prices = (
        charges.where(F.col("drg_code") == drg_code)
        .join(group, "drg_sk")
        .join(dim_provider.select("provider_sk"), "provider_sk")
        .select("provider_sk", "avg_covered_charge", "avg_medicare_payment")
    )
    prices = stage(prices, "prices")
    measures = prices.select(
        "provider_sk",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("measure"), F.col(c).alias("price"))
                    for c in ("avg_covered_charge", "avg_medicare_payment")
                ]
            )
        ),
    )
    shape = exact_percentiles(
        measures, "price", {"p10": 0.1, "p50": 0.5, "p90": 0.9}, ["measure"], ["provider_sk"]
    )
    ends = prices.agg(
        F.count(F.lit(1)).alias("n_hospitals"),
        F.min("avg_covered_charge").alias("min_charge"),
        F.max("avg_covered_charge").alias("max_charge"),
    )
    both = shape.unionByName(ends, allowMissingColumns=True)
    charge, payment = F.col("measure") == "avg_covered_charge", F.col("measure") == "avg_medicare_payment"
    row = both.agg(
        F.max("n_hospitals").alias("n_hospitals"),
        F.max("min_charge").alias("min_charge"),
        F.max(F.when(charge, F.col("p10"))).alias("p10_charge"),
        F.max(F.when(charge, F.col("p50"))).alias("median_charge"),
        F.max(F.when(charge, F.col("p90"))).alias("p90_charge"),
        F.max("max_charge").alias("max_charge"),
        F.max(F.when(payment, F.col("p10"))).alias("_pay_p10"),
        F.max(F.when(payment, F.col("p90"))).alias("_pay_p90"),
    )
    return row.select(
        "n_hospitals",
        "min_charge",
        "p10_charge",
        "median_charge",
        "p90_charge",
        "max_charge",
        guarded_ratio(F.col("max_charge"), F.col("min_charge"), 1).alias("fold_difference"),
        round_stable(guarded_ratio(F.col("_pay_p90"), F.col("_pay_p10")), 1).alias("medicare_pay_p90_p10_ratio"),
    )


def _weighted_sums(charges: DataFrame, key: str) -> DataFrame:
    parts = ["total_discharges", "wtd_covered_charge", "wtd_medicare_payment"]
    return charges.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.sum(p).alias(p) for p in parts])


def _markup(sums: DataFrame, by: list[str], min_discharges: int | None) -> DataFrame:
    n, charge, payment = F.col("total_discharges"), F.col("wtd_covered_charge"), F.col("wtd_medicare_payment")
    rolled = sums.groupBy(*by).agg(
        F.sum(n).alias("discharges"),
        ratio_of_sums(charge, n, 0).alias("wavg_charge"),
        ratio_of_sums(payment, n, 0).alias("wavg_medicare_pay"),
        ratio_of_sums(charge, payment, 2).alias("markup_ratio"),
    )
    if min_discharges is not None:
        rolled = rolled.where(F.col("discharges") > min_discharges)
    return rolled.orderBy(F.desc_nulls_first("markup_ratio"), *by)


def markup_by_service_line(charges: DataFrame, dim_drg: DataFrame, min_discharges: int = 1000) -> DataFrame:
    """Discharge-weighted charge, payment and their ratio by service line, largest markup first."""
    sums = _weighted_sums(charges, "drg_sk").join(dim_drg.select("drg_sk", "service_line"), "drg_sk")
    return _markup(sums, ["service_line"], min_discharges)


def markup_by_state(charges: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """The same by state."""
    sums = _weighted_sums(charges, "geo_sk").join(dim_geography, "geo_sk")
    return _markup(sums, ["state_code", "census_region"], None)


# Levels of the lattice, from the finest to the whole.
MARKUP_LEVELS = [
    ["census_region", "state_code", "service_line"],
    ["census_region", "state_code"],
    ["census_region", "service_line"],
    ["census_region"],
    ["service_line"],
    [],
]


def markup_lattice(charges: DataFrame, dim_drg: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Markup by state and region, with and without the service line, by service line alone and in all.

    The fact is read once and summed by state and diagnosis group before it meets the dimensions; every level comes from these sums, and
    its weighted means from its own sums, never from the means of a finer level.
    """
    parts = ["total_discharges", "wtd_covered_charge", "wtd_medicare_payment"]
    known = charges.where(F.col("geo_sk").isNotNull() & F.col("drg_sk").isNotNull())
    sums = known.groupBy("geo_sk", "drg_sk").agg(*[F.sum(p).alias(p) for p in parts])
    lines = dim_drg.select("drg_sk", "service_line")
    places = dim_geography.select("geo_sk", "state_code", "census_region")
    base = sums.join(lines, "drg_sk").join(places, "geo_sk").groupBy("census_region", "state_code", "service_line")
    rolled = sum_lattice(base.agg(*[F.sum(p).alias(p) for p in parts]), MARKUP_LEVELS, parts)
    n, charge, payment = (F.col(p).cast("double") for p in parts)
    return rolled.select(
        "level",
        "census_region",
        "state_code",
        "service_line",
        F.col(parts[0]).alias("discharges"),
        round_stable(guarded_ratio(charge, n), 0).alias("wavg_charge"),
        round_stable(guarded_ratio(payment, n), 0).alias("wavg_medicare_pay"),
        round_stable(guarded_ratio(charge, payment), 2).alias("markup_ratio"),
    )


def provider_cost_quality(charges: DataFrame, readmissions: DataFrame) -> DataFrame:
    """Hospitals in both facts: provider_sk, mean_medicare_pay (weighted), mean_excess_readmit (over conditions).

    Written, so that the questions about it scan the facts once between them.
    """
    cost = (
        charges.where("provider_sk IS NOT NULL")
        .groupBy("provider_sk")
        .agg(ratio_of_sums(F.col("wtd_medicare_payment"), F.col("total_discharges")).alias("mean_medicare_pay"))
    )
    quality = (
        readmissions.where("provider_sk IS NOT NULL")
        .groupBy("provider_sk")
        .agg(F.avg("excess_readmission_ratio").alias("mean_excess_readmit"))
        .where("mean_excess_readmit IS NOT NULL")
    )
    return stage(cost.join(quality, "provider_sk"), "cost-quality")


def cost_vs_quality(hospitals: DataFrame, buckets: int = 5) -> DataFrame:
    """Hospitals (``provider_cost_quality``) in equal-count buckets by payment, with the means of each bucket."""
    return (
        exact_ntile(hospitals, buckets, "mean_medicare_pay", ["provider_sk"], "pay_quintile")
        .groupBy("pay_quintile")
        .agg(
            F.count(F.lit(1)).alias("n_hospitals"),
            round_stable(F.avg("mean_medicare_pay"), 0).alias("avg_medicare_pay"),
            round_stable(F.avg("mean_excess_readmit"), 4).alias("avg_excess_readmit_ratio"),
        )
        .orderBy("pay_quintile")
    )


def cost_quality_corr(hospitals: DataFrame) -> DataFrame:
    """One row: number of hospitals and the correlation of payment and readmission ratio."""
    r = safe_corr(F.col("mean_medicare_pay"), F.col("mean_excess_readmit"))
    return hospitals.agg(F.count(F.lit(1)).alias("n_hospitals"), round_stable(r, 3).alias("r"))


def explained_variance(hospitals: DataFrame) -> DataFrame:
    """One row: the square of the unrounded correlation."""
    r = safe_corr(F.col("mean_medicare_pay"), F.col("mean_excess_readmit"))
    return hospitals.agg(round_stable(r * r, 4).alias("r_squared"))


def headline_metrics(variance: DataFrame, quintiles: DataFrame, markup: DataFrame) -> DataFrame:
    """One row from the answers: explained variance, pay of the top over the bottom bucket, markup band."""
    buckets = quintiles.agg(
        F.max_by("avg_medicare_pay", "pay_quintile").alias("top"),
        F.min_by("avg_medicare_pay", "pay_quintile").alias("bottom"),
    )
    lines = [
        variance,
        buckets.select(round_stable(guarded_ratio(F.col("top"), F.col("bottom")), 1).alias("pay_ratio_q5_q1")),
        markup.agg(F.min("markup_ratio").alias("markup_min"), F.max("markup_ratio").alias("markup_max")),
    ]
    stacked = lines[0]
    for line in lines[1:]:
        stacked = stacked.unionByName(line, allowMissingColumns=True)
    return stacked.agg(
        F.max("r_squared").alias("r_squared"),
        F.max("pay_ratio_q5_q1").alias("pay_ratio_q5_q1"),
        F.max("markup_min").alias("markup_min"),
        F.max("markup_max").alias("markup_max"),
    )


def charge_leaders(charges: DataFrame, top: int = 1) -> DataFrame:
    """The hospitals with the highest average charge in each diagnosis group."""
    rows = charges.select("drg_code", "ccn", "avg_covered_charge")
    return leaders_per_group(rows, ["drg_code"], [F.desc_nulls_last("avg_covered_charge"), F.col("ccn").asc()], top)


def unmatched_providers(readmissions: DataFrame) -> DataFrame:
    """Readmission rows whose facility is not in the provider dimension, by facility."""
    return readmissions.where("provider_sk IS NULL").groupBy("ccn").agg(F.count(F.lit(1)).alias("n_rows"))
