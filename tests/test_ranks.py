import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators import exact_ntile, exact_percentiles, leaders_per_group, rank_rows, ranks


@pytest.fixture(autouse=True)
def several_partitions(monkeypatch):
    """Small test frames are still spread over all partitions of the session."""
    monkeypatch.setattr(ranks, "LEAST_PARTITION_ROWS", 1)


def order():
    return [F.col("v").asc_nulls_last(), F.col("k").asc()]


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k bigint, v double").repartition(5)


def buckets(df):
    return {r.k: r.b for r in df.select("k", "b").collect()}


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 13, 1000])
@pytest.mark.parametrize("kind", ["tied", "mixed"])
def test_ntile_without_one_task_equals_the_built_in(spark, n, kind):
    rng = random.Random(n)
    values = [1.0] * n if kind == "tied" else [rng.choice([None, 1.0, 2.5, rng.random()]) for _ in range(n)]
    df = frame(spark, values)
    built_in = buckets(df.withColumn("b", F.ntile(5).over(Window.orderBy(*order()))))
    assert buckets(exact_ntile(df, 5, "v", ["k"], "b")) == built_in


def test_rank_rows_counts_from_zero_without_gaps(spark):
    df = rank_rows(frame(spark, [float(i % 7) for i in range(500)]), order())
    rows = df.orderBy("_position").collect()
    assert [r._position for r in rows] == list(range(500))
    assert [(r.v, r.k) for r in rows] == sorted((r.v, r.k) for r in rows)
    assert {r._total for r in rows} == {500}
    files = rank_rows(frame(spark, [float(i % 7) for i in range(500)]), order()).inputFiles()
    assert len(files) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_number_of_partitions_follows_the_rows(spark, monkeypatch):
    df = frame(spark, [float(i) for i in range(900)])
    for least, most, parts in ((1000, 10_000, 1), (300, 10_000, 3), (1, 10_000, 4), (1, 90, 10)):
        monkeypatch.setattr(ranks, "LEAST_PARTITION_ROWS", least)
        monkeypatch.setattr(ranks, "PARTITION_ROWS", most)
        ranked = rank_rows(df, order())
        assert len(ranked.inputFiles()) == parts
        assert [r._position for r in ranked.orderBy("v").collect()] == list(range(900))


def test_hot_value_is_spread_over_partitions(spark):
    """A value that fills most of the input is split by the key, so no partition holds more than its share."""
    df = frame(spark, [1.0] * 4000 + [float(i) for i in range(2000)])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartitionByRange(parts, *order()).groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in spread.collect()) < 2 * 6000 / parts
    ranked = rank_rows(df, order())
    assert ranked.where("v = 1.0").agg(F.max("_position") - F.min("_position")).first()[0] == 4000


def test_percentiles_equal_numpy(spark):
    rng = np.random.default_rng(3)
    groups = {
        "hot": np.where(rng.random(6000) < 0.6, 7.0, rng.normal(size=6000)),
        "wide": rng.normal(size=9000) ** 5,
        None: rng.integers(0, 40, size=5000) / 4,
        "one": np.array([4.25]),
        "two": np.array([1.0, 2.0]),
        "eleven": np.arange(11) * 1.5,
    }
    rows = [(g, i, float(v)) for g, vs in groups.items() for i, v in enumerate(vs)] + [("hot", 99999, None)]
    df = spark.createDataFrame(rows, "g string, k bigint, v double").repartition(4)
    wanted = {"p0": 0.0, "p10": 0.1, "p33": 1 / 3, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = exact_percentiles(df, "v", wanted, ["g"], ["k"])
    assert got.columns == ["g", "n", *wanted]
    found = {r.g: r for r in got.collect()}
    assert found.keys() == groups.keys()
    for g, vs in groups.items():
        assert found[g].n == len(vs)
        for name, p in wanted.items():
            assert found[g][name] == pytest.approx(np.quantile(vs, p), abs=1e-9), (g, name)


@pytest.mark.parametrize("seed", range(3))
def test_percentiles_equal_the_built_in_on_odd_values(spark, seed):
    """Infinities, not-a-numbers, nulls, ties and keys of any name."""
    rng = random.Random(seed)
    odd = [None, float("inf"), float("-inf"), float("nan"), 1.0, 1.0, -0.5, 2.25]
    rows = [(rng.choice(["a", "b", None]), i, rng.choice(odd)) for i in range(rng.choice([7, 60, 400]))]
    rows += [("whole", 1000 + i, float(i)) for i in range(10)] + [("whole", 1010, float("inf"))]
    df = spark.createDataFrame(rows, "n string, i bigint, v double").repartition(3)
    wanted = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    built_in = df.where("v is not null").groupBy(F.col("n").alias("g")).agg(*[F.percentile("v", p).alias(c) for c, p in wanted.items()])
    expected = {r.g: [str(x) for x in r[1:]] for r in built_in.collect()}
    got = exact_percentiles(df.withColumnRenamed("n", "g"), "v", wanted, ["g"], ["i"])
    assert {r.g: [str(x) for x in r[2:]] for r in got.collect()} == expected


def test_ntile_of_dates_with_keys_named_n_and_i(spark):
    df = spark.range(500).selectExpr("id as n", "id % 7 as i", "date_add(date'2024-01-01', cast(id * 13 % 90 as int)) as v")
    order = [F.col("v").asc_nulls_last(), F.col("n"), F.col("i")]
    built_in = {r.n: r.b for r in df.withColumn("b", F.ntile(6).over(Window.orderBy(*order))).collect()}
    assert {r.n: r.b for r in exact_ntile(df, 6, "v", ["n", "i"], "b").collect()} == built_in
    with pytest.raises(TypeError, match="numeric"):
        exact_percentiles(df, "v", {"m": 0.5})


def test_more_buckets_do_not_change_the_plan(spark):
    df = frame(spark, [float(i % 50) for i in range(300)])
    built_in = buckets(df.withColumn("b", F.ntile(100).over(Window.orderBy(*order()))))
    few, many = exact_ntile(df, 5, "v", ["k"], "b"), exact_ntile(df, 100, "v", ["k"], "b")
    assert buckets(many) == built_in
    few, many = (x._jdf.queryExecution().optimizedPlan().toString() for x in (few, many))
    assert len(few.splitlines()) == len(many.splitlines()) and len(many) < 1.1 * len(few)


def test_ntile_with_rows_that_look_alike_on_both_sides_of_a_border(spark):
    df = spark.createDataFrame([(i % 3, 1.0 if i < 900 else 2.0) for i in range(1003)], "k int, v double")
    got = exact_ntile(df, 4, "v", ["k"], "b")
    sizes = {r.b: r["count"] for r in got.groupBy("b").count().collect()}
    assert sizes == {1: 251, 2: 251, 3: 251, 4: 250}
    top = got.groupBy("b").agg(F.min("v"), F.max("v"), F.min("k"), F.max("k")).orderBy("b").collect()
    assert [tuple(r) for r in top] == [(1, 1.0, 1.0, 0, 0), (2, 1.0, 1.0, 0, 1), (3, 1.0, 1.0, 1, 2), (4, 1.0, 2.0, 0, 2)]


@pytest.mark.parametrize("kind", ["bigint", "decimal(20,2)", "int"])
def test_ntile_of_other_number_types(spark, kind):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 37 % 101).cast(kind).alias("v"))
    built_in = buckets(df.withColumn("b", F.ntile(5).over(Window.orderBy(*order()))))
    assert buckets(exact_ntile(df, 5, "v", ["k"], "b")) == built_in


def test_percentiles_of_the_whole_frame_and_of_nothing(spark):
    df = frame(spark, [3.0, 1.0, None, 2.0])
    row = exact_percentiles(df, "v", {"m": 0.5}, key=["k"]).collect()
    assert [tuple(r) for r in row] == [(3, 2.0)]
    none = exact_percentiles(df.where("v > 9"), "v", {"m": 0.5}, key=["k"]).collect()
    assert [tuple(r) for r in none] == [(0, None)]


def test_leaders(spark):
    rows = [("a", 1, 5.0), ("a", 2, 9.0), ("a", 3, 9.0), ("b", 4, None), ("b", 5, 1.0), ("c", 6, None)]
    df = spark.createDataFrame(rows, "g string, k int, v double")
    order = [F.col("v").desc_nulls_last(), F.col("k").asc()]
    best = leaders_per_group(df, ["g"], order)
    assert sorted((r.g, r.k) for r in best.collect()) == [("a", 2), ("b", 5), ("c", 6)]
    assert sorted(r.k for r in leaders_per_group(df, ["g"], order, top=2).collect()) == [2, 3, 4, 5, 6]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
