"""Histories against plain Python, as batches come in order, late, again and corrected."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starmart.operators import as_of, slices
from starmart.operators.history import change_points
from starmart.sinks import History

SCHEMA = "k string, t timestamp, a string, b long, seq long"
START = datetime(2020, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame([(k, t if t is None else START + timedelta(days=t), a, b, s) for k, t, a, b, s in rows], SCHEMA)


def history(spark, folder, buckets=4):
    return History(spark, str(folder), frame(spark, []).drop("seq").schema, ["k"], "t", buckets=buckets)


def merged_by_hand(points, batch):
    """points: {key: {time: attributes}}; only the times of changes are kept."""
    latest = {}
    for k, t, a, b, seq in batch:
        if t is not None:
            rank = (seq, a is not None, a or "", b is not None, b or 0)
            if (k, t) not in latest or rank > latest[k, t][0]:
                latest[k, t] = rank, (a, b)
    for (k, t), (_, attributes) in latest.items():
        points.setdefault(k, {})[t] = attributes
    for k, own in points.items():
        kept, last = {}, None
        for t in sorted(own):
            if last is None or own[t] != last[0]:
                kept[t] = own[t]
            last = (own[t],)
        points[k] = kept
    return points


def versions_of(points):
    rows = []
    for k, own in points.items():
        times = sorted(own)
        for t, until in zip(times, [*times[1:], None]):
            rows.append((k, *own[t], t, until))
    return sorted(rows, key=str)


def stored(table):
    def day(t):
        return None if t is None else (t - START).days

    return sorted(((r.k, r.a, r.b, day(r.valid_from), day(r.valid_to)) for r in table.read().collect()), key=str)


def files(folder):
    return {p.relative_to(folder) for p in Path(folder).rglob("*.parquet")}


def test_a_late_row_splits_the_version_it_falls_into(spark, tmp_path):
    table = history(spark, tmp_path / "h")
    assert table.apply(frame(spark, [("x", 0, "old", 1, 0), ("x", 100, "new", 1, 0), ("y", 5, None, None, 0)])) > 0
    table.apply(frame(spark, [("x", 40, "between", 1, 0), ("x", 60, "between", 1, 0), ("x", -5, "old", 1, 0)]))
    assert stored(table) == versions_of(
        {"x": {-5: ("old", 1), 40: ("between", 1), 100: ("new", 1)}, "y": {5: (None, None)}}
    )
    assert {r.a for r in table.current().collect()} == {"new", None}


def test_applied_twice_changes_nothing(spark, tmp_path):
    table, batch = history(spark, tmp_path / "h"), [("x", 0, "a", 1, 0), ("y", 3, "b", 2, 0), (None, 1, "c", None, 0)]
    assert table.apply(frame(spark, batch)) > 0
    before, rows = files(tmp_path / "h"), stored(table)
    assert table.apply(frame(spark, batch)) == 0 and table.apply(frame(spark, [])) == 0
    assert (files(tmp_path / "h"), stored(table)) == (before, rows)


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = history(spark, tmp_path / "h", buckets=8)
    table.apply(frame(spark, [(f"k{i}", 0, "a", i, 0) for i in range(40)]))
    before = files(tmp_path / "h")
    assert table.apply(frame(spark, [("k7", 9, "b", 7, 0)])) == 1
    after = files(tmp_path / "h")
    assert len({p.parent for p in before ^ after}) == 1 and len({p.parent for p in after}) == 8


def test_nulls_are_values_and_times_are_corrected(spark, tmp_path):
    table = history(spark, tmp_path / "h")
    table.apply(frame(spark, [("x", 0, None, 1, 0), ("x", 1, "1", None, 0), ("x", 2, None, 1, 0), ("x", None, "lost", 0, 0)]))
    assert stored(table) == versions_of({"x": {0: (None, 1), 1: ("1", None), 2: (None, 1)}})
    table.apply(frame(spark, [("x", 1, None, 1, 0), ("x", 1, "loses", 9, -1)]), sequence=["seq"])
    assert stored(table) == versions_of({"x": {0: (None, 1)}})


@pytest.mark.parametrize("slice_rows", [10**6, 25])
def test_random_batches_equal_those_by_hand(spark, tmp_path, monkeypatch, slice_rows):
    monkeypatch.setattr(slices, "SLICE_ROWS", slice_rows)
    rng, table, points = random.Random(slice_rows), history(spark, tmp_path / "h"), {}
    for n in (300, 120, 1):
        batch = [
            (rng.choice(["hot", "hot", "hot", "b", "c", None]), rng.randrange(400), rng.choice("ab"), rng.choice([1, None]), i)
            for i in range(n)
        ]
        table.apply(frame(spark, batch), sequence=["seq"])
        points = merged_by_hand(points, batch)
        assert stored(table) == versions_of(points)


# --- lookup as of a time


def found_by_hand(facts, versions):
    out = []
    for k, t, payload in facts:
        held = None
        for key, start, end, value in versions:
            if key == k and t is not None and start <= t and (held is None or start >= held[0]):
                held = max((start, end is not None, end or 0, value), held or (start, False, 0, ""))
        ok = held is not None and (not held[1] or t < held[2])
        out.append((k, t, payload, held[3] if ok else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("slice_rows", [10**6, 20])
def test_as_of_equals_the_lookup_by_hand(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(slices, "SLICE_ROWS", slice_rows)
    rng = random.Random(5)
    keys = ["hot", "hot", "b", None, "nowhere"]
    facts = [(rng.choice(keys), rng.choice([None, *range(50)]), i % 90) for i in range(400)]
    versions = []
    for k in ("hot", "b", None):
        starts = sorted(rng.sample(range(50), 6))
        versions += [(k, s, e if rng.random() < 0.7 else s + 1, f"{k}{s}") for s, e in zip(starts, [*starts[1:], None])]

    def dated(rows, schema, columns):
        df = spark.createDataFrame(rows, schema)
        return df.withColumns({c: F.timestamp_micros(F.col(c) * 1_000_000) for c in columns})

    left = dated(facts, "k string, t long, payload long", ["t"])
    right = dated(versions, "k string, valid_from long, valid_to long, value string", ["valid_from", "valid_to"])
    found = as_of(left, right, ["k"], "t", ["value"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join" not in plan
    rows = found.select("k", F.unix_seconds("t").alias("t"), "payload", "value").collect()
    assert sorted(map(tuple, rows), key=str) == found_by_hand(facts, versions)


def test_as_of_without_versions_and_with_clashing_names(spark):
    facts = spark.sql("select 'x' as k, timestamp'2020-01-01' as t, 1 as value")
    versions = spark.sql("select 'x' as k, timestamp'2020-01-01' as valid_from, cast(null as timestamp) as valid_to, 2 as held")
    assert as_of(facts, versions, ["k"], "t", ["held"]).first().held == 2
    assert as_of(facts, versions.limit(0), ["k"], "t", ["held"]).first().held is None
    assert as_of(facts.limit(0), versions, ["k"], "t", ["held"]).collect() == []
    with pytest.raises(ValueError, match="value"):
        as_of(facts, versions.withColumnRenamed("held", "value"), ["k"], "t", ["value"])


def test_tasks_of_the_lookup_and_of_histories_follow_the_rows(spark, monkeypatch):
    """With fixed shuffle partitions, what one task sorts grew with the table."""
    monkeypatch.setattr(slices, "SLICE_ROWS", 50)
    facts = spark.range(2000).selectExpr("id % 97 as k", "timestamp_seconds(id * 37 % 1999) as t", "id as payload")
    points = spark.range(1000).selectExpr("id % 97 as k", "timestamp_seconds(id) as valid_from", "id as a", "0 as rank")
    versions = change_points(points, ["k"], ["a"], ["rank"])
    found = as_of(facts, versions, ["k"], "t", ["a"])

    def largest(df):
        return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    assert largest(versions) < 150 and largest(found) < 250
    assert found.count() == 2000 and versions.count() == 1000
