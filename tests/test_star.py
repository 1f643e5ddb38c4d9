"""The whole pipeline on hand-made extracts that hold every trap."""

import csv
import hashlib
import json
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators import check_relationships, dq_report, enforce
from starmart.operators.checks import ChecksFailed
from starmart.plans import build, dims, facts, questions, staging
from starmart.plans.quality import star_checks, strict_checks
from starmart.sinks import Store
from starmart.sources import INPATIENT_CHARGES, READMISSIONS, load_extracts

CHARGE_HEADER = [
    "DRG_CD", "Rndrng_Prvdr_CCN", "Rndrng_Prvdr_Org_Name", "Rndrng_Prvdr_City", "Rndrng_Prvdr_Zip5",
    "Rndrng_Prvdr_State_Abrvtn", "Rndrng_Prvdr_RUCA", "DRG_Desc", "Tot_Dschrgs", "Avg_Submtd_Cvrd_Chrg",
    "Avg_Tot_Pymt_Amt", "Avg_Mdcr_Pymt_Amt", "Surplus",
]
NAME = "ST. MARY'S HOSPITAL-WEST/EAST (MAIN)"
CHARGES = [
    ["470", "010001", NAME, "EL PASO", "00501", "tx", "10", "MAJOR JOINT, NO CC", "100", "50000", "12000", "10000", "x"],
    ["871", "010001", "ST. MARY'S", "EL PASO", "00501", "TX", "2", "SEPSIS", "10", "90000.50", "0", "15000", "x"],
    ["470", "010002", "A&B", "NEW YORK", "10001", "NY", "4.1", "MAJOR JOINT, NO CC", "50", "30000", "9000", "8000", "x"],
    ["470", "010003", "A&B", "SAN JUAN", "00901", "PR", "abc", "MAJOR JOINT, NO CC", "20", "20000", "8000", "9000", "x"],
    ["X01", "010003", "A&B", "SAN JUAN", "00901", "PR", "abc", "ODD", "5", "1000", "900", "800", "x"],
    ["470", "010004", "NO PAY", "RENO", "89501", "NV", "1", "MAJOR JOINT, NO CC", "5", "1000", "900", "0", "x"],
    ["470", "010005", "NEGATIVE", "RENO", "89501", "NV", "1", "MAJOR JOINT, NO CC", "5", "1000", "900", "-1", "x"],
    ["470", "010006", "NULL PAY", "RENO", "89501", "NV", "1", "MAJOR JOINT, NO CC", "5", "1000", "900", "NA", "x"],
    ["194", "010007", "IDLE", "", "", "", "", "PNEUMONIA", "0", "700", "600", "500", "x"],
    ["470", "010008", "DC GENERAL", "WASHINGTON", "20001", "DC", "3", "MAJOR JOINT, NO CC", "n/k", "1", "1", "1", "x"],
    ["291", "010009", "D.C. GENERAL", "WASHINGTON", "20001", "DC", "3", "HEART FAILURE", "40", "40000", "8000", "7500", "x"],
]
HRRP_HEADER = [
    "Facility_Name", "Facility_ID", "State", "Measure_Name", "Number_of_Discharges", "Footnote",
    "Excess_Readmission_Ratio", "Predicted_Readmission_Rate", "Expected_Readmission_Rate",
    "Number_of_Readmissions", "Start_Date", "End_Date",
]
HRRP = [
    [NAME, "010001", "TX", "READM-30-HF-HRRP", "300", "", "1.0500", "21.0", "20.0", "63", "a", "b"],
    [NAME, "010001", "TX", "READM-30-AMI-HRRP", "12.5", "", "0.9500", "19.0", "20.0", "N/A", "a", "b"],
    [NAME, "010001", "TX", "READM-30-PN-HRRP", "1,234", "", "N/A", "N/A", "N/A", "N/A", "a", "b"],
    ["A&B", "010002", "ny", "READM-30-HIP-KNEE-HRRP", "N/A", "5", "1.2000", "1.0d", "NaN", "7", "a", "b"],
    ["A&B", "010003", "PR", "READM-30-NEW-HRRP", "40", "", "0.8000", "9", "10", "4", "a", "b"],
    ["Only here", "990001", "GU", "READM-30-CABG-HRRP", "40", "", "1.1000", "11", "10", "4", "a", "b"],
    ["All hidden", "010009", "DC", "READM-30-HF-HRRP", "N/A", "", "Not Available", "", "N/A", "N/A", "a", "b"],
    ["No id", "", "DC", "READM-30-HF-HRRP", "1", "", "1.0", "1", "1", "1", "a", "b"],
]


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def write_csv(path, header, rows):
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([header, *rows])


def landing(folder, charges=CHARGES):
    folder.mkdir()
    write_csv(folder / "inpatient_charges.csv", CHARGE_HEADER, charges)
    write_csv(folder / "hrrp_readmissions.csv", HRRP_HEADER, HRRP)
    return str(folder)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    return Store(spark, str(tmp_path_factory.mktemp("star")), catalog=False)


@pytest.fixture(scope="module")
def loads(spark, tmp_path_factory, store):
    folder = landing(tmp_path_factory.mktemp("in") / "landing")
    return load_extracts(spark, folder, build.EXTRACTS, store)


@pytest.fixture(scope="module")
def star(loads, store):
    return build.build_star(loads["inpatient_charges"].table, loads["hrrp_readmissions"].table, store)


def by(df, *key):
    rows = df.collect()
    found = {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r for r in rows}
    assert len(found) == len(rows)
    return found


def test_load_counts_and_types(loads):
    charges, readmissions = loads["inpatient_charges"], loads["hrrp_readmissions"]
    assert (charges.rows, charges.rejected) == (10, 1)
    assert (readmissions.rows, readmissions.rejected) == (7, 1)
    assert [f.dataType for f in charges.table.schema] == [f.dataType for f in INPATIENT_CHARGES]
    assert readmissions.table.columns == READMISSIONS.fieldNames()


def test_staging_charges(loads):
    rows = by(staging.stg_inpatient_charges(loads["inpatient_charges"].table), "ccn", "drg_code")
    assert {k for k in rows} == {
        ("010001", "470"), ("010001", "871"), ("010002", "470"), ("010003", "470"), ("010003", "X01"),
        ("010007", "194"), ("010009", "291"),
    }
    joint, sepsis = rows["010001", "470"], rows["010001", "871"]
    assert joint.provider_name == "St. Mary's Hospital-West/East (Main)"
    assert (joint.provider_city, joint.provider_state, joint.provider_zip) == ("El Paso", "TX", "00501")
    assert (joint.markup_ratio, joint.medicare_share) == (Decimal("5.00"), Decimal("0.833"))
    assert (sepsis.markup_ratio, sepsis.medicare_share) == (Decimal("6.00"), None)


def test_staging_readmissions(loads):
    rows = by(staging.stg_readmissions(loads["hrrp_readmissions"].table), "ccn", "measure_raw")
    assert len(rows) == 7
    heart = rows["010001", "READM-30-AMI-HRRP"]
    assert (heart.condition, heart.discharges, heart.readmissions) == ("Heart attack", 13, None)
    assert heart.excess_readmission_ratio == 0.95
    hip = rows["010002", "READM-30-HIP-KNEE-HRRP"]
    assert (hip.state, hip.discharges, hip.predicted_rate, hip.expected_rate) == ("NY", None, None, None)
    assert rows["010003", "READM-30-NEW-HRRP"].condition == "READM-30-NEW-HRRP"
    assert rows["010001", "READM-30-PN-HRRP"].discharges is None
    assert rows["010009", "READM-30-HF-HRRP"].excess_readmission_ratio is None


def test_dim_provider_takes_each_greatest_text_on_its_own(star):
    rows = by(star["dim_provider"], "ccn")
    assert rows.keys() == {"010001", "010002", "010003", "010007", "010009"}
    mary = rows["010001"]
    assert mary.provider_sk == md5("010001")
    assert mary.provider_name == max("St. Mary's Hospital-West/East (Main)", "St. Mary's")
    assert mary.urbanicity == "Metro"  # the greater text of '10' and '2' is '2'
    assert [rows[c].urbanicity for c in ("010002", "010003", "010007", "010009")] == ["Micro", "Rural", "Rural", "Metro"]


def test_dim_drg_and_geography(star):
    drg = by(star["dim_drg"], "drg_code")
    assert {c: (r.service_line, r.is_common_drg) for c, r in drg.items()} == {
        "470": ("Musculoskeletal", True),
        "871": ("Infectious/sepsis", True),
        "194": ("Respiratory", False),
        "291": ("Circulatory", True),
        "X01": ("Other", False),
    }
    assert drg["470"].drg_sk == md5("470")
    states = by(star["dim_geography"], "state_code")
    assert {s: r.census_region for s, r in states.items()} == {
        "TX": "South", "NY": "Northeast", "PR": "Other", "DC": "South",
    }


def test_fact_charges(star, loads):
    rows = by(star["fact_inpatient_charges"], "ccn", "drg_code")
    assert len(rows) == 7
    joint = rows["010001", "470"]
    assert (joint.provider_sk, joint.drg_sk, joint.geo_sk) == (md5("010001"), md5("470"), md5("TX"))
    assert (joint.wtd_covered_charge, joint.wtd_medicare_payment) == (Decimal("5000000.00"), Decimal("1000000.00"))
    assert rows["010007", "194"].geo_sk is None
    assert star["fact_inpatient_charges"].schema["wtd_covered_charge"].dataType.simpleString() == "decimal(35,2)"


def test_keys_made_in_place_equal_looked_up_keys(star, loads):
    stg = staging.stg_inpatient_charges(loads["inpatient_charges"].table)
    looked_up = facts.fact_inpatient_charges(stg, star["dim_provider"], star["dim_drg"], star["dim_geography"])
    assert sorted(map(str, looked_up.collect())) == sorted(map(str, star["fact_inpatient_charges"].collect()))


def test_dims_from_thinned_hospitals_equal_dims_from_all_charges(star, loads):
    stg = staging.stg_inpatient_charges(loads["inpatient_charges"].table)
    for name, dim in (("dim_provider", dims.dim_provider(stg)), ("dim_geography", dims.dim_geography(stg))):
        assert sorted(map(str, dim.collect())) == sorted(map(str, star[name].collect()))


def test_fact_readmissions_keeps_unknown_facilities_with_null_keys(star):
    rows = by(star["fact_readmissions"], "ccn", "measure_raw")
    assert {k[0] for k in rows} == {"010001", "010002", "010003", "990001"}
    only = rows["990001", "READM-30-CABG-HRRP"]
    assert (only.provider_sk, only.geo_sk, only.condition) == (None, None, "CABG (bypass)")
    assert by(questions.unmatched_providers(star["fact_readmissions"]), "ccn")["990001"].n_rows == 1


def test_lookup_that_misses_gives_null_and_two_descriptions_double_the_fact(spark, star, loads):
    stg = staging.stg_inpatient_charges(loads["inpatient_charges"].table)
    doubled = star["dim_drg"].union(star["dim_drg"].where("drg_code = '470'"))
    none = star["dim_geography"].limit(0)
    fact = facts.fact_inpatient_charges(stg, star["dim_provider"].where("ccn <> '010002'"), doubled, none)
    rows = fact.collect()
    assert len(rows) == 7 + 3
    assert {r.geo_sk for r in rows} == {None}
    assert {r.ccn for r in rows if r.provider_sk is None} == {"010002"}


def test_declared_checks(star):
    report = {(r.check_name, r.model, r.column_name): r.failures for r in dq_report(star_checks(star)).collect()}
    assert len(report) == 19
    failing = {k: v for k, v in report.items() if v}
    assert failing == {("accepted_values", "fact_readmissions", "condition"): 1}
    strict = {(r.check_name, r.column_name): r.failures for r in dq_report(strict_checks(star)).collect()}
    assert strict == {
        ("relationships_strict", "provider_sk"): 1,
        ("grain", "ccn, drg_code"): 0,
        ("grain", "ccn, measure_raw"): 0,
    }


def test_second_description_of_a_group_is_caught(spark, tmp_path):
    twice = [*CHARGES, ["470", "010009", "D", "W", "20001", "DC", "3", "JOINT", "1", "2", "2", "2", "x"]]
    folder = landing(tmp_path / "landing", twice)
    with pytest.raises(ChecksFailed, match="unique dim_drg.drg_code: 1 failures"):
        build.run(spark, folder, Store(spark, str(tmp_path / "t"), catalog=False))


def test_run_from_files_to_tables(spark, tmp_path):
    """The clean part of the fixture goes through: tables are in the catalog and the checks pass."""
    folder = tmp_path / "landing"
    landing(folder)
    write_csv(folder / "hrrp_readmissions.csv", HRRP_HEADER, [r for r in HRRP if r[3] != "READM-30-NEW-HRRP"])
    done = build.run_reported(spark, str(folder), Store(spark, str(tmp_path / "tables")))
    star = done.star
    assert done.totals == {"PASS": 21, "WARN": 1, "ERROR": 0, "TOTAL": 22}
    assert done.report.where("status = 'WARN'").first().failures == 1
    assert {name: load.rows for name, load in done.loads.items()} == {
        "inpatient_charges": spark.table("raw.inpatient_charges").count(),
        "hrrp_readmissions": spark.table("raw.hrrp_readmissions").count(),
    }
    assert build.answer(star, "price_variation").first().n_hospitals == 3
    assert enforce(dq_report(star_checks(star))) == {"PASS": 19, "WARN": 0, "ERROR": 0, "TOTAL": 19}
    build.save_answers(star, str(tmp_path / "results"))
    assert spark.read.parquet(str(tmp_path / "results" / "price_variation")).first().n_hospitals == 3
    assert spark.read.parquet(str(tmp_path / "results" / "charge_leaders")).count() == 5
    assert spark.table("marts.fact_inpatient_charges").count() == 7
    assert spark.table("stg_inpatient_charges").count() == 7
    orphans = check_relationships(
        spark.table("stg_readmissions"), "stg_readmissions", "ccn", spark.table("marts.dim_provider"), "ccn"
    )
    assert orphans.first().failures == 1
    (folder / "inpatient_charges.csv").unlink()
    with pytest.raises(FileNotFoundError, match="inpatient_charges"):
        build.run(spark, str(folder), Store(spark, str(tmp_path / "again"), catalog=False))


def test_saved_pages_load_like_the_file(spark, tmp_path, loads):
    records = [dict(zip(HRRP_HEADER, row, strict=True)) for row in HRRP]
    (tmp_path / "pages").mkdir()
    for i in range(0, len(records), 3):
        (tmp_path / "pages" / f"{i}.json").write_text(json.dumps({"results": records[i : i + 3]}))
    (tmp_path / "landing").mkdir()
    build.land_pages(spark, str(tmp_path / "pages"), READMISSIONS, str(tmp_path / "landing" / "hrrp_readmissions.csv"))
    paged = load_extracts(spark, str(tmp_path / "landing"), build.EXTRACTS, Store(spark, str(tmp_path / "t"), catalog=False))
    table = paged["hrrp_readmissions"].table
    assert sorted(map(str, table.collect())) == sorted(map(str, loads["hrrp_readmissions"].table.collect()))


def test_clustered_fact_has_the_same_rows(spark, tmp_path, star, loads):
    raw = loads["inpatient_charges"].table, loads["hrrp_readmissions"].table
    clustered = build.build_star(*raw, Store(spark, str(tmp_path), catalog=False), cluster_charges=True)
    name = "fact_inpatient_charges"
    assert sorted(map(str, clustered[name].collect())) == sorted(map(str, star[name].collect()))


def test_price_variation(star):
    row = questions.price_variation(
        star["fact_inpatient_charges"], star["dim_drg"], star["dim_provider"], "470"
    ).collect()
    assert len(row) == 1
    r = row[0]
    assert (r.n_hospitals, r.min_charge, r.max_charge) == (3, Decimal("20000.00"), Decimal("50000.00"))
    assert (r.p10_charge, r.median_charge, r.p90_charge) == (22000.0, 30000.0, 46000.0)
    assert (float(r.fold_difference), r.medicare_pay_p90_p10_ratio) == (2.5, 1.2)
    none = questions.price_variation(
        star["fact_inpatient_charges"], star["dim_drg"], star["dim_provider"], "999"
    ).first()
    assert (none.n_hospitals, none.median_charge, none.fold_difference) == (0, None, None)


def test_markup_weights_by_discharges_and_drops_small_lines(star):
    rows = questions.markup_by_service_line(star["fact_inpatient_charges"], star["dim_drg"], 9).collect()
    assert [r.service_line for r in rows] == ["Infectious/sepsis", "Circulatory", "Musculoskeletal"]
    joint = rows[2]
    n, charge, pay = 170, 100 * 50000 + 50 * 30000 + 20 * 20000, 100 * 10000 + 50 * 8000 + 20 * 9000
    assert (joint.discharges, joint.wavg_charge, joint.wavg_medicare_pay, joint.markup_ratio) == (
        n, round(charge / n), round(pay / n), round(charge / pay, 2),
    )
    assert questions.markup_by_service_line(star["fact_inpatient_charges"], star["dim_drg"]).collect() == []


def test_markup_by_state_leaves_out_charges_without_a_state(star):
    rows = by(questions.markup_by_state(star["fact_inpatient_charges"], star["dim_geography"]), "state_code")
    assert rows.keys() == {"TX", "NY", "PR", "DC"}
    assert (rows["PR"].census_region, rows["PR"].discharges) == ("Other", 25)


def test_cost_quality_joins_only_hospitals_in_both_facts(star):
    charges, readmissions = star["fact_inpatient_charges"], star["fact_readmissions"]
    rows = by(questions.provider_cost_quality(charges, readmissions), "provider_sk")
    assert rows.keys() == {md5(c) for c in ("010001", "010002", "010003")}
    assert rows[md5("010001")].mean_medicare_pay == pytest.approx((100 * 10000 + 10 * 15000) / 110)
    assert rows[md5("010001")].mean_excess_readmit == pytest.approx(1.0)
    corr = questions.cost_quality_corr(questions.provider_cost_quality(charges, readmissions)).first()
    assert corr.n_hospitals == 3


def test_cost_vs_quality_buckets(star):
    hospitals = questions.provider_cost_quality(star["fact_inpatient_charges"], star["fact_readmissions"])
    rows = questions.cost_vs_quality(hospitals, 2).collect()
    assert [(r.pay_quintile, r.n_hospitals) for r in rows] == [(1, 2), (2, 1)]
    assert rows[0].avg_excess_readmit_ratio == 1.0
    assert rows[1].avg_medicare_pay == round((100 * 10000 + 10 * 15000) / 110)


def test_headline_and_leaders(star):
    charges, readmissions = star["fact_inpatient_charges"], star["fact_readmissions"]
    hospitals = questions.provider_cost_quality(charges, readmissions)
    quintiles, corr = questions.cost_vs_quality(hospitals, 2), questions.cost_quality_corr(hospitals)
    markup = questions.markup_by_service_line(charges, star["dim_drg"], 9)
    r = questions.headline_metrics(questions.explained_variance(hospitals), quintiles, markup).first()
    assert (r.markup_min, r.markup_max) == (min(x.markup_ratio for x in markup.collect()), 6.0)
    assert r.r_squared == pytest.approx(corr.first().r ** 2, abs=1e-4)
    pay = [x.avg_medicare_pay for x in quintiles.collect()]
    assert r.pay_ratio_q5_q1 == round(pay[1] / pay[0], 1)
    leaders = by(questions.charge_leaders(charges), "drg_code")
    assert (leaders["470"].ccn, len(leaders)) == ("010001", 5)


def test_hot_hospital(spark):
    """A hospital with a third of all charges: whole results by every road, checked by hand-made sums."""
    hot = [("H", f"{i:05d}", "TX", i % 7 + 1, Decimal(i % 50 + 1)) for i in range(2000)]
    cold = [(f"C{i % 400:03d}", f"{i // 400:05d}", "NY", 2, Decimal(i % 90 + 1)) for i in range(4000)]
    df = spark.createDataFrame(hot + cold, "ccn string, drg_code string, provider_state string, n bigint, pay decimal(14,2)")
    fact = df.select(
        F.md5("ccn").alias("provider_sk"),
        F.col("n").alias("total_discharges"),
        (F.col("pay") * F.col("n")).alias("wtd_medicare_payment"),
    )
    quality = df.select(F.md5("ccn").alias("provider_sk"), (F.col("n") / 2).alias("excess_readmission_ratio"))
    sums = defaultdict(lambda: [0, 0])
    for ccn, _, _, n, pay in hot + cold:
        sums[md5(ccn)][0] += n * pay
        sums[md5(ccn)][1] += n
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (threshold, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            rows = by(questions.provider_cost_quality(fact, quality), "provider_sk")
            assert rows.keys() == sums.keys()
            for key, (w, n) in sums.items():
                assert rows[key].mean_medicare_pay == pytest.approx(float(w) / n)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
