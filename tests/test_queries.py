"""Every registered query against DuckDB on the smallest trial tables."""

import shutil
from pathlib import Path

import compare
import duckdb
import pytest

import __spark_entry__ as driver

from starmart.trial.oracle import oracle_sql  # noqa: E402
from starmart.trial.queries import QUERIES  # noqa: E402

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def duck(trial_dir):
    return compare.connect(trial_dir)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= driver.queries().keys() and ORACLE.keys() <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, trial_dir, duck, name):
    assert compare.differences(QUERIES[name](spark, trial_dir), duck, ORACLE[name]) == []


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_ends_in_a_cross_join(spark, trial_dir, name):
    plan = QUERIES[name](spark, trial_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["q1_price_variation", "q2_markup", "q3_cost_vs_quality", "check_relationships"])
def test_query_equals_sql_without_broadcast(spark, trial_dir, duck, name):
    """The road taken when no side is small: sort-merge joins, including for building the star."""
    from starmart.trial import mart

    kept = dict(mart._star), dict(mart._raw)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    mart._star.clear(), mart._raw.clear()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert compare.differences(QUERIES[name](spark, trial_dir), duck, ORACLE[name]) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        mart._star.update(kept[0]), mart._raw.update(kept[1])


@pytest.fixture(scope="module")
def skewed_dir(trial_dir, tmp_path_factory):
    """The trial tables with five times the line items, a third of them of one order, part and supplier, half at one price."""
    folder = tmp_path_factory.mktemp("skewed")
    for file in Path(trial_dir).glob("*.parquet"):
        (folder / file.name).symlink_to(file)
    (folder / "lineitem.parquet").unlink()
    duckdb.connect().execute(
        f"""copy (
          select if(h % 3 = 0, 5, l_orderkey) as l_orderkey, if(h % 3 = 0, 11, l_partkey) as l_partkey,
                 if(h % 3 = 0, 7, l_suppkey) as l_suppkey, l_linenumber, l_quantity,
                 if(h % 2 = 0, 1000.0, l_extendedprice) as l_extendedprice,
                 l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
          from (select *, hash(l_orderkey * 31 + l_partkey * 17 + copy_no) as h
                from '{trial_dir}/lineitem.parquet', range(5) c(copy_no))
        ) to '{folder}/lineitem.parquet' (format parquet)"""
    )
    return str(folder)


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
}


@pytest.mark.parametrize(
    "name",
    ["fact_charges", "fact_readmissions", "q1_price_variation", "q2_markup", "q3_cost_vs_quality", "leaders_per_group",
     "percentiles_scaled", "ntile_scaled", "ntile_100", "check_unique", "check_relationships", "check_grain"],
)
def test_query_equals_sql_with_hot_keys(spark, skewed_dir, name):
    kept = {key: spark.conf.get(key) for key in SKEW_CONF}
    try:
        for key, value in SKEW_CONF.items():
            spark.conf.set(key, value)
        assert compare.differences(QUERIES[name](spark, skewed_dir), compare.connect(skewed_dir), ORACLE[name]) == []
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)


def test_changed_input_is_not_answered_from_old_tables(spark, trial_dir, tmp_path):
    for file in Path(trial_dir).glob("*.parquet"):
        shutil.copyfile(file, tmp_path / file.name)
    before = QUERIES["load_audit"](spark, str(tmp_path)).first()
    duckdb.connect().execute(
        f"copy (select * from '{trial_dir}/lineitem.parquet' where l_suppkey < 5) to '{tmp_path}/lineitem.parquet'"
    )
    after = QUERIES["load_audit"](spark, str(tmp_path)).first()
    assert after.n_readmissions < before.n_readmissions


def test_every_check_can_fail(spark, trial_dir):
    rows = QUERIES["dq_report_dirty"](spark, trial_dir.replace("sf0.001", "sf0.01")).collect()
    assert len(rows) == 19 and all(r.failures > 0 for r in rows)
    assert {r.status for r in rows if r.check_name == "relationships"} == {"WARN"}
    assert {r.status for r in rows if r.check_name != "relationships"} == {"ERROR"}


def test_entry(spark, trial_dir):
    assert driver.entry(spark).count() == 5
