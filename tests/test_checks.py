from datetime import datetime, timedelta

import pytest

from starmart.operators import (
    check_columns,
    check_freshness,
    check_grain,
    check_relationships,
    check_unique,
    dq_report,
    enforce,
)
from starmart.operators.checks import ChecksFailed


@pytest.fixture(scope="module")
def child(spark):
    rows = [("a", 1, 0.5), ("a", 1, -1.0), ("b", 2, None), (None, 3, 2.0), ("z", 4, 0.0), ("z", 4, 0.0), (None, 5, 1.0)]
    return spark.createDataFrame(rows, "k string, n int, v double")


@pytest.fixture(scope="module")
def parent(spark):
    return spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "pk string")


def failures(df):
    return {(r.check_name, r.model, r.column_name): r.failures for r in df.collect()}


def test_column_checks_pass_over_nulls_except_not_null(child):
    got = failures(
        check_columns(
            child,
            "t",
            not_null=["k", "v", "n"],
            accepted_values={"k": ["a", "b"]},
            accepted_range={"v": (0, None), "n": (2, 4)},
        )
    )
    assert got == {
        ("not_null", "t", "k"): 2,
        ("not_null", "t", "v"): 1,
        ("not_null", "t", "n"): 0,
        ("accepted_values", "t", "k"): 2,
        ("accepted_range", "t", "v"): 1,
        ("accepted_range", "t", "n"): 3,
    }
    strict = check_columns(child, "t", accepted_range={"v": (0, 2)}, inclusive=False)
    assert failures(strict) == {("accepted_range", "t", "v"): 4}


def test_unique_counts_repeated_values_not_rows(child):
    assert failures(check_unique(child, "t", ["k", "n", "v"])) == {
        ("unique", "t", "k"): 2,
        ("unique", "t", "n"): 2,
        ("unique", "t", "v"): 1,
    }
    assert set(failures(check_unique(child.limit(0), "t", ["k"])).values()) == {0}


def test_grain_counts_nulls_as_values(child):
    assert failures(check_grain(child, "t", ["k", "n"])) == {("grain", "t", "k, n"): 2}


def test_relationships_ignore_null_keys_unless_strict(child, parent):
    assert failures(check_relationships(child, "t", "k", parent, "pk")) == {("relationships", "t", "k"): 2}
    strict = check_relationships(child, "t", "k", parent, "pk", strict=True)
    assert failures(strict) == {("relationships_strict", "t", "k"): 4}
    none = check_relationships(child.where("k = 'a'"), "t", "k", parent, "pk")
    assert failures(none) == {("relationships", "t", "k"): 0}


def test_report_and_enforce(child, parent):
    good = dq_report([check_columns(child, "t", not_null=["n"]), check_columns(parent, "p", accepted_values={"pk": ["a", "b"]})])
    assert enforce(good) == {"PASS": 2, "WARN": 0, "ERROR": 0, "TOTAL": 2}
    tolerated = dq_report([check_columns(child, "t", not_null=["n"])], [check_columns(child, "t", not_null=["k"])])
    assert enforce(tolerated) == {"PASS": 1, "WARN": 1, "ERROR": 0, "TOTAL": 2}
    bad = dq_report([check_columns(child, "t", not_null=["n", "k"])])
    assert sorted(r.status for r in bad.collect()) == ["ERROR", "PASS"]
    with pytest.raises(ChecksFailed, match="not_null t.k: 2 failures"):
        enforce(bad)


@pytest.mark.parametrize(
    ("hours", "status"), [(1, "PASS"), (24, "PASS"), (25, "WARN"), (72, "WARN"), (73, "ERROR")]
)
def test_freshness(spark, hours, status):
    loaded = datetime(2024, 1, 1)
    df = spark.createDataFrame([(loaded,), (loaded - timedelta(days=9),)], "t timestamp_ntz")
    row = check_freshness(
        df, "m", "t", loaded + timedelta(hours=hours), timedelta(days=1), timedelta(days=3)
    ).first()
    assert (row.model, row.column_name, row.age_seconds, row.status) == ("m", "t", hours * 3600.0, status)
    empty = check_freshness(df.limit(0), "m", "t", loaded, timedelta(days=1)).first()
    assert (empty.age_seconds, empty.status) == (None, "ERROR")
