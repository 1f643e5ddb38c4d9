"""What several years of releases need, on the trial tables: histories, snapshots, releases, intervals and sessions."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import (
    as_of,
    change_points,
    distinct_in_windows,
    over_keys,
    over_time,
    overlapping_pairs,
    period_sketches,
    period_values,
    periodic_snapshot,
    release_difference,
    scratch_path,
    sketched_in_windows,
    stage,
    year_dimension,
)
from ..operators.history import FROM, TO
from ..operators.slices import spread
from ..sinks import History, SessionTable, write_landing
from ..sources import ReleaseTable
from .extracts import table

GAP = timedelta(hours=6)
WINDOW_MONTHS = 3
# Share by which a sketched number may miss the exact one: about six standard errors.
SKETCH_ERROR = 0.05


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp")).alias(column)


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an order says of its customer: status and priority, from the day of the order on."""
    return table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("timestamp").alias("at"), "o_orderkey"
    )


def q_scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches in order of time, one of late orders of all years, and that one once more."""
    orders = stage(_observations(spark, sf_dir), "observations")
    late, early = F.col("o_orderkey") % 10 == 3, F.year("at") < 1999
    schema = orders.drop("o_orderkey").schema
    history = History(spark, scratch_path(spark, "customer-history"), schema, ["o_custkey"], "at", buckets=16)
    for batch in (orders.where(early & ~late), orders.where(~early & ~late), orders.where(late)):
        history.apply(batch, sequence=["o_orderkey"])
    if history.apply(orders.where(late), sequence=["o_orderkey"]):
        raise AssertionError("a batch that is applied again must change nothing")
    return history.read().select("o_custkey", "o_orderstatus", "o_orderpriority", _micros(FROM), _micros(TO))


def q_fact_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the status and priority that their customer had when they were shipped."""
    attributes = ["o_orderstatus", "o_orderpriority"]
    points = _observations(spark, sf_dir).withColumnRenamed("at", FROM)
    versions = stage(change_points(points, ["o_custkey"], attributes, ["o_orderkey"]), "customer-versions")
    customers = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("timestamp").alias("l_shipdate")
    )
    rows = lines.count()
    facts = spread(lines, rows, "l_orderkey").join(spread(customers, rows, "l_orderkey"), "l_orderkey")
    # An order is one row of its table, so the join keeps the number of lines.
    found = as_of(facts, versions, ["o_custkey"], "l_shipdate", attributes, rows=rows)
    return found.withColumn("l_shipdate", _micros("l_shipdate"))


def _amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their total as the customer's balance from then on and as an amount that flows."""
    total = F.col("o_totalprice").cast("decimal(14,2)")
    return table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", total.alias("balance"), total.alias("amount")
    )


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By nation and month: customers in their active span, their balances and amounts."""
    snapshot = periodic_snapshot(
        _amounts(spark, sf_dir), ["o_custkey"], "o_orderdate", ["balance"], ["amount"], order=["o_orderkey"]
    )
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return over_keys(snapshot.join(customers, "o_custkey"), ["c_nationkey"], ["balance"], ["amount"])


def _figures(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"period": F.col("period").cast("string"), **{c: F.col(c).cast("double") for c in ("balance", "amount")}}
    )


def q_snapshot_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _figures(_monthly(spark, sf_dir))


def q_snapshot_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _figures(over_time(_monthly(spark, sf_dir), ["c_nationkey"], ["balance"], ["amount"]))


def q_year_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = year_dimension(table(spark, sf_dir, "orders"), "o_orderdate")
    return years.withColumns({c: F.col(c).cast("string") for c in ("first_day", "last_day")})


_RELEASE_SCHEMA = T.StructType(
    [
        T.StructField("order_key", T.StringType(), nullable=False),
        T.StructField("status", T.StringType()),
        T.StructField("total", T.DecimalType(14, 2)),
    ]
)


def _release_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as they land, one release for every three years."""
    total = F.col("o_totalprice").cast("decimal(14,2)")
    return table(spark, sf_dir, "orders").select(
        F.floor((F.year("o_orderdate") - 1995) / 3).alias("part"),
        F.col("o_orderkey").alias("number"),
        F.col("o_orderkey").cast("string").alias("order_key"),
        F.when(F.col("o_orderstatus") == "P", F.lit("NA")).otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderkey") % 50 == 7, F.lit("n/k")).otherwise(total.cast("string")).alias("total"),
    )


def q_release_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three releases; the second is loaded again as it is, and again after a correction that changes, adds and drops rows."""
    cells = stage(_release_cells(spark, sf_dir), "releases")
    folder, releases = scratch_path(spark, "landing"), ReleaseTable(spark, scratch_path(spark, "releases"), _RELEASE_SCHEMA)
    columns = _RELEASE_SCHEMA.fieldNames()
    for part in range(3):
        write_landing(cells.where(F.col("part") == part).select(*columns), f"{folder}/{part}")
        releases.load(f"r{part}", f"{folder}/{part}")
    again = releases.load("r1", f"{folder}/1")
    second = cells.where((F.col("part") == 1) & (F.col("number") % 4 != 1))
    changed = F.when(F.col("number") % 4 == 2, F.lit("C")).otherwise(F.col("status"))
    write_landing(second.withColumn("status", changed).select(*columns), f"{folder}/1")
    corrected = releases.load("r1", f"{folder}/1")
    if again.written or not corrected.written:
        raise AssertionError("a release is loaded anew when its files change, and only then")
    good = releases.read().select("release", *columns).withColumn("total", F.col("total").cast("double"))
    bad = releases.rejects().select("release", F.get_json_object("reject_record", "$.order_key").alias("order_key"))
    return good.unionByName(bad.withColumn("status", F.lit("rejected")), allowMissingColumns=True)


def q_release_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two made releases of all orders with repeated, missing, new and changed rows, and nulls on both sides."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        F.when(key % 97 != 5, key).alias("o_orderkey"),
        F.when(key % 6 != 1, F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority",
        F.col("o_totalprice").cast("decimal(14,2)").alias("o_totalprice"),
        key.alias("number"),
    )
    number = F.col("number")
    old = orders.where(number % 7 != 3).union(orders.where(number % 11 == 0))
    new = orders.where(number % 5 != 2).union(orders.where(number % 22 == 0)).withColumns(
        {
            "o_orderstatus": F.when(number % 13 == 4, F.lit("X")).otherwise(F.col("o_orderstatus")),
            "o_totalprice": F.when(number % 17 != 9, F.col("o_totalprice")),
        }
    )
    return release_difference(old.drop("number"), new.drop("number"), ["o_orderkey"])


def q_distinct_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an order in the three months up to each one, by priority: exact, and whether the sketch is close."""
    orders, by = table(spark, sf_dir, "orders"), ["o_orderpriority"]
    values = stage(period_values(orders, by, "o_orderdate", "o_custkey"), "monthly-customers")
    sketches = stage(period_sketches(orders, by, "o_orderdate", "o_custkey"), "monthly-sketches")
    exact = distinct_in_windows(values, by, "o_custkey", WINDOW_MONTHS)
    both = exact.join(sketched_in_windows(sketches, by, WINDOW_MONTHS), [*by, "period"])
    off = F.abs(F.col("n_sketched") - F.col("n_distinct")) / F.col("n_distinct")
    return both.select(*by, F.col("period").cast("string"), "n_distinct", (off <= SKETCH_ERROR).alias("sketch_is_close"))


def q_open_order_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one customer that are open at the same time: from their date to the last shipment, or for a day."""
    shipped = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    shipped = shipped.agg(F.max("l_shipdate").cast("timestamp").alias("shipped"))
    placed = F.col("o_orderdate").cast("timestamp")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", placed.alias("opened"))
    closed = F.greatest(F.col("shipped"), F.col("opened") + F.expr("interval 1 day"))
    spans = orders.join(shipped, "o_orderkey", "left").withColumn("closed", closed)
    pairs = overlapping_pairs(spans, ["o_custkey"], "o_orderkey", "opened", "closed")
    return pairs.withColumns({c: _micros(c) for c in ("overlap_from", "overlap_to")})


def q_event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three batches: the first half of the month, the second, and then a seventh of all, late."""
    events = table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("decimal(18,2)").alias("value"), "event_id"
    )
    events = stage(events, "events")
    late, first = F.col("event_id") % 7 == 0, F.dayofmonth("ts") <= 15
    kept = SessionTable(
        spark, scratch_path(spark, "sessions"), events.drop("event_id").schema, ["user_id"], "ts", GAP, ["value"], buckets=16
    )
    for batch in (events.where(first & ~late), events.where(~first & ~late), events.where(late)):
        kept.apply(batch)
    return kept.read().select(
        "user_id", _micros("session_start"), _micros("session_end"), "n_events", F.col("value").cast("double").alias("value")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scd2_history": q_scd2_history,
    "fact_as_of": q_fact_as_of,
    "year_dimension": q_year_dimension,
    "snapshot_by_month": q_snapshot_by_month,
    "snapshot_by_year": q_snapshot_by_year,
    "release_load": q_release_load,
    "release_diff": q_release_diff,
    "distinct_by_window": q_distinct_by_window,
    "open_order_overlaps": q_open_order_overlaps,
    "event_sessions": q_event_sessions,
}
