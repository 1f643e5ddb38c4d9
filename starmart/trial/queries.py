"""Every operator on the trial tables: name -> function of (spark, sf_dir).

Money and ratios are returned as double, counts as bigint, so that results compare with other engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    in_list,
    label_by_member,
    label_by_range,
    label_by_threshold,
    map_values,
    null_tokens,
    round_stable,
    surrogate_key,
    title_case,
    try_float,
    try_number,
    weighted_avg,
)
from ..operators import (
    check_columns,
    check_freshness,
    check_grain,
    check_relationships,
    check_unique,
    dq_report,
    exact_ntile,
    exact_percentiles,
    scratch_path,
)
from ..plans import questions
from ..plans.lookups import CENSUS_REGIONS, COMMON_CODES, CONDITIONS, OTHER, RURAL, SERVICE_LINES, URBANICITY
from ..plans.quality import star_checks
from ..plans.staging import stg_inpatient_charges, stg_readmissions
from ..sinks import Store, write_landing
from ..sources import (
    INPATIENT_CHARGES,
    READMISSIONS,
    latest_distribution,
    load_audit,
    load_table,
    read_catalog,
    read_landing,
    read_pages,
)
from ..sources.landing import REASON, RECORD
from . import mart, years
from .extracts import MEASURES, RUCA_CODES, STATES, _pick, loaded_readmissions, padded, table

Query = Callable[[SparkSession, str], DataFrame]
PERCENTAGES = {"p10": 0.1, "p50": 0.5, "p90": 0.9}


def _doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Interpolated values of money have three exact decimals; the fourth drops the noise of double arithmetic."""
    return df.withColumns({c: round_stable(F.col(c), 4) for c in columns})


def _by_remainder(key: Column, values: list[str], default: Column) -> Column:
    """``values[key % n]`` with one more remainder than values for ``default``."""
    chain = F
    for i, value in enumerate(values):
        chain = chain.when(key % (len(values) + 1) == i, F.lit(value))
    return chain.otherwise(default)


def _stg_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_inpatient_charges(mart.raw(spark, sf_dir, "inpatient_charges"))


def _stg_readmissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_readmissions(mart.raw(spark, sf_dir, "hrrp_readmissions"))


# Ingest


def q_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    raw = _by_remainder(key, ["", "NA", "Not Available", "N/A", "na"], F.col("o_orderpriority"))
    cells = table(spark, sf_dir, "orders").select(key.alias("id"), raw.alias("raw"))
    return cells.withColumn("cleaned", null_tokens(F.col("raw")))


def q_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = {"charges": "inpatient_charges", "readmissions": "hrrp_readmissions"}
    return load_audit({alias: mart.raw(spark, sf_dir, name) for alias, name in raw.items()})


def q_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files of two headers in one folder: a column less, one more, another order and other letter case; loaded by name."""
    landed = mart.raw(spark, sf_dir, "landed_readmissions").drop("Footnote")
    other = landed.withColumn("Extra", F.lit('a "quoted", cell'))
    folder = scratch_path(spark, "landing")
    late = F.coalesce(F.regexp_replace("Facility_ID", "H", "").cast("bigint") % 2 == 1, F.lit(False))
    write_landing(other.where(late).select(*[F.col(c).alias(c.upper()) for c in sorted(other.columns)]), folder)
    write_landing(landed.where(~late), folder, mode="append")
    store = Store(spark, scratch_path(spark, "load"), catalog=False)
    loaded = load_table(read_landing(spark, folder), READMISSIONS, store, "hrrp_readmissions").table
    return loaded.select(*[F.col(f.name).alias(f.name.lower()) for f in READMISSIONS])


def q_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unparsable counts and missing codes in a fifth of the groups, and a row too short and one too long for each hospital.

    All of them must be set aside: reason, and the text of the row or the hospital that its record names.
    """
    raw = mart.raw(spark, sf_dir, "inpatient_charges")
    key = F.col("Rndrng_Prvdr_CCN").cast("bigint")
    size = (F.col("DRG_Cd").cast("int") - 2) / 18 + 1
    spot = F.when(size % 5 == 0, key % 3)
    landed = raw.withColumns(
        {
            "Tot_Dschrgs": F.when(spot == 0, F.lit("n/k")).otherwise(F.col("Tot_Dschrgs").cast("string")),
            "DRG_Cd": F.when(spot == 1, F.lit("NA")).otherwise(F.col("DRG_Cd")),
        }
    )
    folder = scratch_path(spark, "landing")
    write_landing(landed, folder)
    ccn = padded(F.col("s_suppkey"), 6)
    lines = F.explode(F.array(F.concat(ccn, F.lit(",short")), F.concat(ccn, F.lit(",long" * len(INPATIENT_CHARGES)))))
    # Whole lines, header included, as one column that nothing separates.
    broken = table(spark, sf_dir, "supplier").select(lines.alias(",".join(INPATIENT_CHARGES.fieldNames())))
    broken.write.mode("append").options(header=True, sep="\u0001").csv(folder)
    store = Store(spark, scratch_path(spark, "load"), catalog=False)
    rejects = load_table(read_landing(spark, folder), INPATIENT_CHARGES, store, "inpatient_charges").rejects
    told = F.coalesce(F.get_json_object(RECORD, "$.Rndrng_Prvdr_CCN"), RECORD).alias("told")
    return rejects.groupBy(REASON, told).agg(F.count(F.lit(1)).alias("n_rows"))


def q_paged_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved pages of an API answer: 200 facilities x 5 measures, so 1000 records at most, per page."""
    landed = mart.raw(spark, sf_dir, "landed_readmissions")
    number = F.regexp_replace("Facility_ID", "H", "").cast("bigint")
    pages = landed.groupBy(F.floor(number / 200).alias("page")).agg(
        F.collect_list(F.struct(*landed.columns)).alias("results")
    )
    folder = scratch_path(spark, "pages")
    pages.select("results").write.json(folder)
    records = loaded_readmissions(read_pages(spark, folder, READMISSIONS, multi_line=False))
    return records.select(*[F.col(f.name).alias(f.name.lower()) for f in READMISSIONS])


def q_latest_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved catalog with datasets of each year of orders; the CSV link of the newest is known only by its ending.

    Each year is there twice, with other links, and once with too few digits for a year; a second kind of dataset has no CSV.
    """
    year = F.year("o_orderdate")
    years = table(spark, sf_dir, "orders").groupBy(year.alias("yr")).agg(F.count(F.lit(1)).alias("n"))

    def link(media: str | None, ending: str) -> Column:
        url = F.concat(F.lit("https://example.org/orders-"), F.col("yr"), F.lit(ending))
        return F.struct(F.lit(media).cast("string").alias("mediaType"), url.alias("downloadURL"))

    def entry(place: int, name: str, digits: Column, *links: Column) -> Column:
        title = F.concat(F.lit(f"Orders by {name} : "), digits)
        return F.struct((F.col("yr") * 10 + place).alias("place"), title.alias("title"), F.array(*links).alias("distribution"))

    whole = F.col("yr").cast("string")
    entries = F.explode(
        F.array(
            entry(0, "priority and day", whole, link("application/json", ".json"), link(None, ".CSV"), link("text/csv", ".txt")),
            entry(1, "priority and day", whole, link("text/csv", ".second")),
            entry(2, "priority and day", F.right(whole, F.lit(2)), link("text/csv", ".short")),
            entry(3, "clerk", whole, link("application/json", ".json")),
        )
    )
    ordered = F.array_sort(F.collect_list("entry"))
    document = years.select(entries.alias("entry")).agg(F.transform(ordered, lambda e: e.dropFields("place")).alias("dataset"))
    folder = scratch_path(spark, "catalog")
    document.write.json(folder)
    catalog = read_catalog(spark, folder)
    found = latest_distribution(catalog, "by priority and day").union(latest_distribution(catalog, "by clerk"))
    return found.withColumn("year", F.col("year").cast("bigint"))


# Staging and functions


def q_stg_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    money = ("avg_covered_charge", "avg_total_payment", "avg_medicare_payment", "markup_ratio", "medicare_share")
    return _doubles(_stg_charges(spark, sf_dir), *money)


def q_initcap_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(
        F.upper("p_name"), F.lit("-"), F.col("p_type"), F.lit("/O'"), F.col("p_brand"),
        F.lit(" ("), F.col("p_name"), F.lit(")&co."),
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw_name"))
    return parts.withColumn("clean_name", title_case(F.col("raw_name")))


def q_initcap_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", title_case(F.col("text")).alias("titled"))


def q_try_cast_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = ["N/A", "", "12.5", " 12 ", "1e3", "1,234", "NaN", "1.0d", "-7.49"]
    price = F.col("o_totalprice").cast("decimal(14,2)").cast("string")
    cells = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), _by_remainder(F.col("o_orderkey"), odd, price).alias("raw")
    )
    return cells.withColumns({"whole": try_number(F.col("raw")), "real": try_float(F.col("raw"))})


def q_condition_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four known measures; the fifth priority stands for a measure without a label."""
    known = dict(list(MEASURES.items())[:4])
    priority = F.col("o_orderpriority")
    measure = F.when(priority.isin(*known), map_values(priority, known)).otherwise(F.lower(priority))
    cells = table(spark, sf_dir, "orders").select("o_orderkey", measure.alias("measure"))
    return cells.withColumn("condition", map_values(F.col("measure"), CONDITIONS))


def q_service_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    code = F.when(key % 50 == 0, F.concat(F.lit("X"), F.col("p_size"))).otherwise(padded(key % 1000, 3))
    codes = table(spark, sf_dir, "part").groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n_parts"))
    numbered = codes.withColumn("number", try_number(F.col("code")))
    return numbered.withColumn("service_line", label_by_range(F.col("number"), SERVICE_LINES, OTHER)).drop("number")


def q_census_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when(F.col("s_suppkey") % 9 != 4, _pick(STATES, F.col("s_nationkey")))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", state.alias("state_code"))
    return suppliers.withColumn("census_region", label_by_member(F.col("state_code"), CENSUS_REGIONS, OTHER))


def q_urbanicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruca = _by_remainder(F.col("c_custkey"), RUCA_CODES, F.lit(None))
    customers = table(spark, sf_dir, "customer").select("c_custkey", ruca.alias("ruca_code"))
    parsed = customers.withColumn("ruca", try_float(F.col("ruca_code")))
    return parsed.withColumn("urbanicity", label_by_threshold(F.col("ruca"), URBANICITY, RURAL)).drop("ruca")


def q_common_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("p_partkey") % 11 != 0, padded(F.col("p_partkey") % 1000, 3))
    parts = table(spark, sf_dir, "part").select("p_partkey", code.alias("drg_code"))
    return parts.withColumn("is_common_drg", in_list(F.col("drg_code"), COMMON_CODES))


def q_surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.when(F.col("c_custkey") % 7 != 3, F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        surrogate_key(F.col("c_custkey")).alias("customer_sk"),
        surrogate_key(segment, F.col("c_nationkey")).alias("segment_sk"),
    )


# Star and questions


def _star_table(name: str, *money: str) -> Query:
    return lambda spark, sf_dir: _doubles(mart.star(spark, sf_dir)[name], *money)


def q_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = mart.star(spark, sf_dir)
    row = questions.price_variation(s["fact_inpatient_charges"], s["dim_drg"], s["dim_provider"])
    row = _doubles(row, "min_charge", "max_charge", "fold_difference")
    return _rounded(row, "p10_charge", "median_charge", "p90_charge")


def q_percentiles_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    charges = _stg_charges(spark, sf_dir)
    return _rounded(
        exact_percentiles(charges, "avg_covered_charge", PERCENTAGES, ["drg_code"], ["ccn"]), *PERCENTAGES
    )


LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def q_line_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of the price of all line items, in three groups."""
    lines = table(spark, sf_dir, "lineitem")
    found = exact_percentiles(lines, "l_extendedprice", PERCENTAGES, ["l_returnflag"], LINE_KEYS)
    return _rounded(found, *PERCENTAGES)


def q_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = mart.star(spark, sf_dir)
    return questions.markup_by_service_line(s["fact_inpatient_charges"], s["dim_drg"])


def q_markup_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = mart.star(spark, sf_dir)
    return questions.markup_by_state(s["fact_inpatient_charges"], s["dim_geography"]).drop("geo_sk")


def q_markup_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = mart.star(spark, sf_dir)
    return questions.markup_lattice(s["fact_inpatient_charges"], s["dim_drg"], s["dim_geography"])


def q_weighted_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    charge, n = F.col("avg_covered_charge"), F.col("total_discharges")
    naive = round_stable(F.sum(charge).cast("double") / F.count(charge), 2)
    return (
        _stg_charges(spark, sf_dir)
        .groupBy("provider_state")
        .agg(weighted_avg(charge, n, 2).alias("weighted"), naive.alias("naive"))
    )


def _hospitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = mart.star(spark, sf_dir)
    return questions.provider_cost_quality(s["fact_inpatient_charges"], s["fact_readmissions"])


def q_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.cost_vs_quality(_hospitals(spark, sf_dir))


def q_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.cost_quality_corr(_hospitals(spark, sf_dir))


def q_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    hospitals = _hospitals(spark, sf_dir)
    variance, quintiles = questions.explained_variance(hospitals), questions.cost_vs_quality(hospitals)
    return questions.headline_metrics(variance, quintiles, q_q2(spark, sf_dir))


def q_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(questions.charge_leaders(_stg_charges(spark, sf_dir)), "avg_covered_charge")


def _line_buckets(buckets: int) -> Query:
    """Equal-count buckets of all line items by price."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = table(spark, sf_dir, "lineitem").select("l_extendedprice", *LINE_KEYS)
        return (
            exact_ntile(lines, buckets, "l_extendedprice", LINE_KEYS, "pay_quintile")
            .groupBy("pay_quintile")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.min("l_extendedprice").alias("min_key"),
                F.max("l_extendedprice").alias("max_key"),
            )
        )

    return query


# Checks


def _stack(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames).drop("check_name")


def q_check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared columns, and two fact columns that do repeat."""
    s = mart.star(spark, sf_dir)
    return _stack(
        check_unique(s["dim_provider"], "dim_provider", ["provider_sk", "ccn"]),
        check_unique(s["dim_drg"], "dim_drg", ["drg_sk", "drg_code"]),
        check_unique(s["dim_geography"], "dim_geography", ["geo_sk"]),
        check_unique(s["fact_inpatient_charges"], "fact_inpatient_charges", ["drg_sk", "ccn"]),
    )


def q_check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared columns, and three that do hold nulls."""
    s = mart.star(spark, sf_dir)
    return _stack(
        check_columns(s["dim_provider"], "dim_provider", not_null=["provider_sk", "ccn"]),
        check_columns(s["dim_drg"], "dim_drg", not_null=["drg_sk", "drg_code", "service_line"]),
        check_columns(s["dim_geography"], "dim_geography", not_null=["geo_sk"]),
        check_columns(s["fact_inpatient_charges"], "fact_inpatient_charges", not_null=["provider_sk"]),
        check_columns(s["fact_readmissions"], "fact_readmissions", not_null=["provider_sk", "geo_sk"]),
        check_columns(_stg_readmissions(spark, sf_dir), "stg_readmissions", not_null=["discharges"]),
    )


def q_check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared lists, and one that leaves out a value that occurs."""
    s = mart.star(spark, sf_dir)
    regions, conditions = [*CENSUS_REGIONS, OTHER], list(CONDITIONS.values())
    return _stack(
        check_columns(s["dim_geography"], "dim_geography", accepted_values={"census_region": regions}),
        check_columns(s["fact_readmissions"], "fact_readmissions", accepted_values={"condition": conditions}),
        check_columns(s["dim_provider"], "dim_provider", accepted_values={"urbanicity": ["Metro", "Micro"]}),
    )


def q_check_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared ranges, and a narrow one with open ends that many rows miss."""
    s = mart.star(spark, sf_dir)
    payment, ratio = "avg_medicare_payment", "excess_readmission_ratio"
    return _stack(
        check_columns(s["fact_inpatient_charges"], "fact_inpatient_charges", accepted_range={payment: (0, None)}),
        check_columns(s["fact_readmissions"], "fact_readmissions", accepted_range={ratio: (0, None)}),
        check_columns(
            _stg_readmissions(spark, sf_dir), "stg_readmissions", accepted_range={ratio: (0.9, 1.1)}, inclusive=False
        ),
    )


def q_check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared keys; then the facilities they cannot see, by natural key and by the strict rule."""
    s = mart.star(spark, sf_dir)
    charges, readmissions, provider = s["fact_inpatient_charges"], s["fact_readmissions"], s["dim_provider"]
    return _stack(
        check_relationships(charges, "fact_inpatient_charges", "provider_sk", provider, "provider_sk"),
        check_relationships(charges, "fact_inpatient_charges", "drg_sk", s["dim_drg"], "drg_sk"),
        check_relationships(readmissions, "fact_readmissions", "provider_sk", provider, "provider_sk"),
        check_relationships(_stg_readmissions(spark, sf_dir), "stg_readmissions", "ccn", provider, "ccn"),
        check_relationships(
            readmissions, "fact_readmissions strict", "provider_sk", provider, "provider_sk", strict=True
        ),
    )


def q_check_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = mart.star(spark, sf_dir)
    return _stack(
        check_grain(s["fact_inpatient_charges"], "fact_inpatient_charges", ["ccn", "drg_code"]),
        check_grain(s["fact_readmissions"], "fact_readmissions", ["ccn", "measure_raw"]),
        check_grain(table(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]),
    )


def q_unmatched_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.unmatched_providers(mart.star(spark, sf_dir)["fact_readmissions"])


def q_check_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    as_of = datetime(2024, 2, 1)
    return check_freshness(events, "events", "ts", as_of, timedelta(days=1), timedelta(days=30))


def q_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_report(star_checks(mart.star(spark, sf_dir)))


def _dirty_star(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The star with repeated, missing, unknown and negative cells wherever a code ends in a given digit."""

    def ends(column: str, digit: str):
        return F.right(F.col(column), F.lit(1)) == digit

    def spoil(df: DataFrame, column: str, condition, value) -> DataFrame:
        return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)).cast(df.schema[column].dataType))

    def repeat(df: DataFrame, again, missing, columns: list[str]) -> DataFrame:
        nulls = {c: F.lit(None).cast("string") for c in columns}
        return df.union(df.where(again)).union(df.where(missing).withColumns(nulls))

    provider, drg, geography = star["dim_provider"], star["dim_drg"], star["dim_geography"]
    charges, readmissions = star["fact_inpatient_charges"], star["fact_readmissions"]
    provider = repeat(provider, ends("ccn", "7"), ends("ccn", "8"), ["provider_sk", "ccn"])
    drg = repeat(drg, ends("drg_code", "0"), ends("drg_code", "6"), ["drg_sk", "drg_code", "service_line"])
    geography = repeat(geography, F.col("state_code") > "M", F.col("state_code") < "M", ["geo_sk"])
    geography = spoil(geography, "census_region", F.col("geo_sk").isNull(), F.lit("Nowhere"))
    charges = spoil(charges, "provider_sk", ends("ccn", "1"), F.lit(None))
    charges = spoil(charges, "provider_sk", ends("ccn", "2"), F.lit("unknown"))
    charges = spoil(charges, "avg_medicare_payment", ends("drg_code", "2"), -F.col("avg_medicare_payment"))
    charges = spoil(charges, "drg_sk", ends("drg_code", "4"), F.lit("unknown"))
    readmissions = spoil(readmissions, "condition", ends("ccn", "1"), F.lit("Unknown"))
    readmissions = spoil(readmissions, "excess_readmission_ratio", ends("ccn", "2"), F.lit(-1))
    readmissions = spoil(readmissions, "provider_sk", ends("ccn", "3"), F.lit("nobody"))
    tables = {"dim_provider": provider, "dim_drg": drg, "dim_geography": geography}
    return {**star, **tables, "fact_inpatient_charges": charges, "fact_readmissions": readmissions}


def q_dq_report_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 19 checks where each has failures; those of relationships only warn."""
    checks = star_checks(_dirty_star(mart.star(spark, sf_dir)))
    relations = {7, 8, 10}
    return dq_report(
        [c for i, c in enumerate(checks) if i not in relations], [c for i, c in enumerate(checks) if i in relations]
    )


_FACT_MONEY = (
    "avg_covered_charge",
    "avg_total_payment",
    "avg_medicare_payment",
    "markup_ratio",
    "medicare_share",
    "wtd_covered_charge",
    "wtd_medicare_payment",
)

QUERIES: dict[str, Query] = {
    "null_tokens": q_null_tokens,
    "load_audit": q_load_audit,
    "csv_load": q_csv_load,
    "csv_rejects": q_csv_rejects,
    "paged_json": q_paged_json,
    "latest_distribution": q_latest_distribution,
    "stg_charges": q_stg_charges,
    "stg_readmissions": _stg_readmissions,
    "initcap_names": q_initcap_names,
    "initcap_texts": q_initcap_texts,
    "try_cast_clean": q_try_cast_clean,
    "condition_label": q_condition_label,
    "service_line": q_service_line,
    "census_region": q_census_region,
    "urbanicity": q_urbanicity,
    "common_flag": q_common_flag,
    "surrogate_keys": q_surrogate_keys,
    "dim_provider": _star_table("dim_provider"),
    "dim_drg": _star_table("dim_drg"),
    "dim_geography": _star_table("dim_geography"),
    "fact_charges": _star_table("fact_inpatient_charges", *_FACT_MONEY),
    "fact_readmissions": _star_table("fact_readmissions"),
    "q1_price_variation": q_q1,
    "percentiles_by_group": q_percentiles_by_group,
    "percentiles_scaled": q_line_percentiles,
    "percentiles_sketched": q_line_percentiles,
    "q2_markup": q_q2,
    "markup_by_state": q_markup_by_state,
    "markup_lattice": q_markup_lattice,
    "weighted_avg": q_weighted_avg,
    "q3_cost_vs_quality": q_q3,
    "cost_quality_corr": q_corr,
    "headline_metrics": q_headline,
    "leaders_per_group": q_leaders,
    "ntile_scaled": _line_buckets(5),
    "ntile_sketched": _line_buckets(5),
    "ntile_100": _line_buckets(100),
    "check_unique": q_check_unique,
    "check_not_null": q_check_not_null,
    "check_accepted_values": q_check_accepted_values,
    "check_accepted_range": q_check_accepted_range,
    "check_relationships": q_check_relationships,
    "check_grain": q_check_grain,
    "unmatched_providers": q_unmatched_providers,
    "check_freshness": q_check_freshness,
    "dq_report": q_dq_report,
    "dq_report_dirty": q_dq_report_dirty,
    **years.QUERIES,
}
