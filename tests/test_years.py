"""Snapshots, releases, differences, lattices, distinct counts, intervals and sessions against plain Python."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators import (
    bag_difference,
    distinct_in_windows,
    over_keys,
    over_time,
    overlapping_pairs,
    period_sketches,
    period_values,
    periodic_snapshot,
    release_difference,
    sessions,
    sketched_in_windows,
    slices,
    sum_lattice,
    year_dimension,
)
from starmart.sinks import SessionTable
from starmart.sources import ReleaseTable

START = datetime(2021, 11, 3)


def same_rows(df, expected):
    assert sorted(map(tuple, df.collect()), key=str) == sorted(expected, key=str)


# --- year dimension and snapshots


def test_years_without_rows_are_in_the_dimension(spark):
    dates = spark.sql("select explode(array(date'2019-05-01', date'2021-01-01', cast(null as date))) as d")
    rows = year_dimension(dates, "d").orderBy("year").collect()
    assert [(r.year, r.n_days, r.is_leap) for r in rows] == [(2019, 365, False), (2020, 366, True), (2021, 365, False)]
    assert (rows[1].first_day, rows[1].last_day) == (date(2020, 1, 1), date(2020, 12, 31))
    assert year_dimension(dates.where("d is null"), "d").collect() == []


FACTS = [
    # key, time, order, level, flow
    ("a", datetime(2021, 11, 3), 1, 10, 1),
    ("a", datetime(2021, 11, 3), 2, 11, 2),
    ("a", datetime(2021, 11, 1), 9, 99, 4),
    ("a", datetime(2022, 2, 28), 1, None, 8),
    ("b", datetime(2022, 1, 31), 1, 5, None),
    (None, datetime(2022, 1, 1), 1, 7, 1),
    ("c", None, 1, 1, 1),
]


def test_spans_are_filled_and_levels_carried(spark):
    facts = spark.createDataFrame(FACTS, "k string, t timestamp, o int, level long, flow long")
    snapshot = periodic_snapshot(facts, ["k"], "t", ["level"], ["flow"], order=["o"])
    same_rows(
        snapshot,
        [
            ("a", date(2021, 11, 1), 3, 11, 7),
            ("a", date(2021, 12, 1), 0, 11, 0),
            ("a", date(2022, 1, 1), 0, 11, 0),
            ("a", date(2022, 2, 1), 1, None, 8),
            ("b", date(2022, 1, 1), 1, 5, 0),
            (None, date(2022, 1, 1), 1, 7, 1),
        ],
    )
    months = over_keys(snapshot, [], ["level"], ["flow"])
    same_rows(
        months,
        [(date(2021, 11, 1), 1, 3, 11, 7), (date(2021, 12, 1), 1, 0, 11, 0), (date(2022, 1, 1), 3, 2, 23, 1), (date(2022, 2, 1), 1, 1, None, 8)],
    )
    same_rows(over_time(months, [], ["level"], ["flow"]), [(date(2021, 1, 1), 1, 3, 11, 7), (date(2022, 1, 1), 1, 3, None, 9)])
    assert periodic_snapshot(facts.where("t is null"), ["k"], "t", ["level"], []).collect() == []


# --- releases

RELEASE = T.StructType(
    [T.StructField("id", T.StringType(), nullable=False), T.StructField("name", T.StringType()), T.StructField("n", T.LongType())]
)


def land(folder, **files):
    folder.mkdir(exist_ok=True)
    for old in folder.glob("*.csv"):
        old.unlink()
    for name, lines in files.items():
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")


def test_a_release_is_loaded_once_and_replaced_when_it_changes(spark, tmp_path):
    table, first, second = ReleaseTable(spark, str(tmp_path / "t"), RELEASE), tmp_path / "2020", tmp_path / "2021"
    land(first, a=["id,name,n", "1,x,10", "2,NA,x", "3,y,30"])
    land(second, a=["id,name,n", "1,x,11"], b=["id,name,n", "4,z,40"])
    assert table.load("2020", str(first)) == table.load("2020", str(first)).__class__(True, 2, 1)
    assert table.load("2021", str(second)).rows == 2
    again = ReleaseTable(spark, str(tmp_path / "t"), RELEASE)
    assert not again.load("2020", str(first)).written and not again.load("2021", str(second)).written
    assert again.ledger().count() == 3 and again.read().count() == 4 and again.rejects().count() == 1
    parts = {p for p in (tmp_path / "t" / "rows" / "release=2020").glob("*.parquet")}
    land(second, a=["id,name,n", "1,x,12", "5,w,50", "6,w,60"])
    assert table.load("2021", str(second)).rows == 3
    same_rows(table.read(), [("1", "x", 10, "2020"), ("3", "y", 30, "2020"), ("1", "x", 12, "2021"), ("5", "w", 50, "2021"), ("6", "w", 60, "2021")])
    assert {p for p in (tmp_path / "t" / "rows" / "release=2020").glob("*.parquet")} == parts
    assert [r.file for r in table.ledger().where("release = '2021'").collect()] == ["a.csv"]


def test_an_empty_release_is_an_error_and_changes_nothing(spark, tmp_path):
    table, folder = ReleaseTable(spark, str(tmp_path / "t"), RELEASE), tmp_path / "r"
    land(folder, a=["id,name,n", "1,x,10"])
    table.load("r", str(folder))
    land(folder, a=["id,name,n"])
    with pytest.raises(ValueError, match="no rows"):
        table.load("r", str(folder))
    land(folder)
    with pytest.raises(FileNotFoundError):
        table.load("r", str(folder))
    same_rows(table.read(), [("1", "x", 10, "r")])


# --- differences


def test_differences_of_random_bags(spark):
    rng = random.Random(3)
    pick = lambda: (rng.choice([1, 2, 3, 4, None]), rng.choice(["a", "b", None]), rng.choice([0.5, None]))
    old, new = [pick() for _ in range(60)], [pick() for _ in range(50)]
    schema = "k int, a string, b double"
    left, right = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    counted = Counter(new)
    counted.subtract(old)
    same_rows(bag_difference(left, right), [(*row, n) for row, n in counted.items() if n])
    lost, gained = defaultdict(list), defaultdict(list)
    for (k, *rest), n in counted.items():
        (gained if n > 0 else lost)[k] += [rest] * abs(n)
    expected = []
    for k in lost.keys() | gained.keys():
        kind = "changed" if k in lost and k in gained else "added" if k in gained else "removed"
        names = [c for i, c in enumerate("ab") if Counter(r[i] for r in lost[k]) != Counter(r[i] for r in gained[k])]
        expected.append((k, kind, len(lost[k]), len(gained[k]), ",".join(names) if kind == "changed" else None))
    same_rows(release_difference(left, right.select("b", "k", "a"), ["k"]), expected)
    assert release_difference(left, left, ["k"]).collect() == []


def test_only_changed_columns_are_named(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "x", 1)], "k int, a string, b int")
    new = spark.createDataFrame([(1, "a", 1), (2, "y", 1)], "k int, a string, b int")
    rows = {r.k: r.changed_columns for r in release_difference(old, new, ["k"]).collect()}
    assert rows == {1: "b", 2: "a"}


# --- lattice


def test_levels_come_from_one_base(spark):
    base = spark.createDataFrame([("n", "x", 1), ("n", None, 2), ("s", "x", 4)], "region string, line string, n long")
    rows = sum_lattice(base, [["region", "line"], ["region"], ["line"], []], ["n"])
    same_rows(
        rows.select("level", "region", "line", "n"),
        [("region x line", "n", "x", 1), ("region x line", "n", None, 2), ("region x line", "s", "x", 4), ("region", "n", None, 3),
         ("region", "s", None, 4), ("line", None, "x", 5), ("line", None, None, 2), ("all", None, None, 7)],
    )


# --- distinct values in windows


def test_exact_and_sketched_windows(spark):
    rng = random.Random(1)
    rows = [(rng.choice("gh"), START + timedelta(days=rng.randrange(300)), rng.randrange(3000)) for _ in range(6000)]
    rows += [("g", START, None), ("g", None, 5)]
    df = spark.createDataFrame(rows, "g string, t timestamp, v long")
    exact = {(r.g, r.period): r.n_distinct for r in distinct_in_windows(period_values(df, ["g"], "t", "v"), ["g"], "v", 3).collect()}
    expected, last = defaultdict(set), max(t for _, t, _ in rows if t)
    for g, t, v in rows:
        if t is not None and v is not None:
            for ahead in range(3):
                month = t.month - 1 + ahead
                period = date(t.year + month // 12, month % 12 + 1, 1)
                if period <= last.date():
                    expected[g, period].add(v)
    assert exact == {key: len(values) for key, values in expected.items()}
    sketched = sketched_in_windows(period_sketches(df, ["g"], "t", "v"), ["g"], 3).collect()
    assert len(sketched) == len(exact)
    assert all(abs(r.n_sketched - exact[r.g, r.period]) <= 0.05 * exact[r.g, r.period] for r in sketched)


# --- intervals


@pytest.mark.parametrize("longest", [3, 5000])
def test_overlaps_equal_those_of_all_pairs(spark, longest):
    rng = random.Random(longest)
    spans = []
    for i in range(250):
        start, length = rng.randrange(2000), rng.choice([0, 1, 2, 3, rng.randrange(longest)])
        spans.append((rng.choice(["hot", "hot", "b", None]), i, START + timedelta(hours=start - 1000), START + timedelta(hours=start - 1000 + length)))
    spans += [("b", 900, None, START), ("b", 901, START, None), ("b", 902, START, START - timedelta(days=1))]
    df = spark.createDataFrame(spans, "k string, id long, a timestamp, b timestamp")
    expected = [
        (k, i, j, max(a, c), min(b, d))
        for n, (k, i, a, b) in enumerate(spans[:250])
        for (m, j, c, d) in spans[n + 1 : 250]
        if k == m and a < d and c < b and a < b and c < d
    ]
    pairs = overlapping_pairs(df, ["k"], "id", "a", "b")
    same_rows(pairs, expected)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert overlapping_pairs(df.limit(0), ["k"], "id", "a", "b").collect() == []


# --- sessions

GAP = timedelta(minutes=30)


def sessions_by_hand(events):
    by_key, out = defaultdict(list), []
    for k, t, v in events:
        if t is not None:
            by_key[k].append((t, v))
    for k, own in by_key.items():
        own.sort()
        start = end = None
        for t, v in own:
            if end is None or t - end > GAP:
                if end is not None:
                    out.append((k, start, end, n, total))
                start, n, total = t, 0, 0
            end, n, total = t, n + 1, total + v
        out.append((k, start, end, n, total))
    return out


@pytest.mark.parametrize("slice_rows", [10**6, 15])
def test_sessions_of_batches_equal_those_of_all_events(spark, tmp_path, monkeypatch, slice_rows):
    monkeypatch.setattr(slices, "SLICE_ROWS", slice_rows)
    rng = random.Random(slice_rows)
    events = [
        (rng.choice(["hot", "hot", "hot", "b", None]), START + timedelta(minutes=rng.randrange(3000)), rng.randrange(9))
        for _ in range(260)
    ]
    events += [("b", None, 1), ("hot", START, 1), ("hot", START, 1)]
    schema = T._parse_datatype_string("k string, t timestamp, v long")
    table = SessionTable(spark, str(tmp_path / "s"), schema, ["k"], "t", GAP, ["v"], buckets=4)
    rng.shuffle(events)
    for at in (0, 120, 240):
        table.apply(spark.createDataFrame(events[at : at + 120], schema))
        same_rows(table.read(), sessions_by_hand(events[: at + 120]))


def test_a_late_event_joins_two_sessions_and_touches_one_bucket(spark, tmp_path):
    schema = T._parse_datatype_string("k string, t timestamp, v long")
    table = SessionTable(spark, str(tmp_path / "s"), schema, ["k"], "t", GAP, ["v"], buckets=8)
    table.apply(spark.createDataFrame([(f"k{i}", START + timedelta(minutes=m), 1) for i in range(30) for m in (0, 50)], schema))
    assert table.read().count() == 60
    assert table.apply(spark.createDataFrame([("k3", START + timedelta(minutes=25), 1)], schema)) == 1
    assert table.read().count() == 59
    assert table.read().where("k = 'k3'").first().n_events == 3
    assert table.apply(spark.createDataFrame([], schema)) == 0


def test_spans_of_earlier_sessions_are_spans_like_others(spark):
    minutes = [(0, 90), (20, 20), (100, 100), (131, 131)]
    rows = [("k", START + timedelta(minutes=a), START + timedelta(minutes=b), 1) for a, b in minutes]
    df = spark.createDataFrame(rows, "k string, session_start timestamp, session_end timestamp, n_events long")
    found = sessions(df.withColumn("n_events", F.col("n_events")), ["k"], GAP)
    same_rows(found, [("k", rows[0][1], rows[2][2], 3), ("k", rows[3][1], rows[3][2], 1)])
