"""Year dimension and periodic snapshots of facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import surrogate_key

PERIOD = "period"


def year_dimension(df: DataFrame, time: str) -> DataFrame:
    """One row per calendar year from the first to the last year of ``time``, years without rows included.

    ``year_sk``, ``year``, ``first_day``, ``last_day``, ``n_days`` and ``is_leap``; empty where no time is known.
    """
    ends = df.agg(F.min(F.year(time)).alias("a"), F.max(F.year(time)).alias("b")).where("a IS NOT NULL")
    years = ends.select(F.explode(F.sequence("a", "b")).alias("year"))
    first = F.make_date("year", F.lit(1), F.lit(1))
    last = F.make_date("year", F.lit(12), F.lit(31))
    days = F.datediff(last, first) + 1
    return years.select(
        surrogate_key(F.col("year")).alias("year_sk"),
        F.col("year").cast("bigint").alias("year"),
        first.alias("first_day"),
        last.alias("last_day"),
        days.cast("bigint").alias("n_days"),
        (days == 366).alias("is_leap"),
    )


def periodic_snapshot(
    facts: DataFrame,
    keys: Sequence[str],
    time: str,
    levels: Sequence[str],
    flows: Sequence[str],
    order: Sequence[str] = (),
    grain: str = "month",
) -> DataFrame:
    """One row per key and period of its active span: ``period`` (its first day), ``n_facts``, levels and flows.

    The span runs from a key's first to its last period with a fact; only that is filled in, so the snapshot grows with activity and
    not with keys times periods. A level is the value at the period's end: that of the last fact, by time and then ``order``, carried over
    periods without one. A flow is the sum of the period's facts, nothing in a gap. Facts without a time are left out; null keys are
    keys like others; a null level counts as a value.

    Facts are summed to (key, period) first, starting on the map side, so a hot key is a row per period when its span is filled in.
    """
    period = F.date_trunc(grain, F.col(time)).cast("date").alias(PERIOD)
    at = F.struct(time, *order, *levels)
    held = facts.where(F.col(time).isNotNull()).groupBy(*keys, period)
    held = held.agg(
        F.max_by(F.struct(F.lit(0).alias("_none"), *levels), at).alias("_held"),
        F.count(F.lit(1)).alias("n_facts"),
        *[F.sum(f).alias(f) for f in flows],
    )
    following = F.lead(PERIOD).over(Window.partitionBy(*keys).orderBy(PERIOD))
    step = F.expr(f"interval 1 {grain}")
    # Up to the next period with a fact; the last one stands for itself.
    until = F.coalesce((following - step).cast("date"), F.col(PERIOD))
    filled = held.withColumn("_until", until).withColumn("_period", F.explode(F.sequence(PERIOD, "_until", step)))
    own = F.col("_period") == F.col(PERIOD)
    return filled.select(
        *keys,
        F.col("_period").alias(PERIOD),
        F.when(own, F.col("n_facts")).otherwise(0).cast("bigint").alias("n_facts"),
        *[F.col("_held")[level].alias(level) for level in levels],
        *[F.when(own, F.coalesce(F.col(f), F.lit(0))).otherwise(0).cast(held.schema[f].dataType).alias(f) for f in flows],
    )


def over_keys(snapshot: DataFrame, by: Sequence[str], levels: Sequence[str], flows: Sequence[str]) -> DataFrame:
    """Levels and flows summed over the keys of each period and group, with ``n_keys``; both are additive over keys."""
    sums = [F.sum(c).alias(c) for c in (*levels, *flows)]
    return snapshot.groupBy(*by, PERIOD).agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n_facts").alias("n_facts"), *sums)


def over_time(rolled: DataFrame, by: Sequence[str], levels: Sequence[str], flows: Sequence[str], grain: str = "year") -> DataFrame:
    """Periods put together to longer ones: a level, and ``n_keys``, is that of the last period, as levels do not add up over time."""
    longer = F.date_trunc(grain, F.col(PERIOD)).cast("date").alias(PERIOD)
    return rolled.groupBy(*by, longer).agg(
        F.max_by("n_keys", PERIOD).alias("n_keys"),
        F.sum("n_facts").alias("n_facts"),
        *[F.max_by(level, PERIOD).alias(level) for level in levels],
        *[F.sum(f).alias(f) for f in flows],
    )
