"""Declarative data checks. Each returns one row per check: check_name, model, column_name, failures.

Only ``not_null`` fails on null; every other check passes over nulls. Column checks of one table share one scan,
uniqueness checks share one shuffle, and key lookups compare distinct keys, not rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ChecksFailed(RuntimeError):
    """Raised by ``enforce`` when a report holds an error."""


def _rows(one_row: DataFrame, model: str, checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Turn a one-row frame with a column of failures per check into one row per (check, column, source column)."""
    lines = [
        F.struct(
            F.lit(check).alias("check_name"),
            F.lit(model).alias("model"),
            F.lit(column).alias("column_name"),
            F.coalesce(F.col(source), F.lit(0)).cast("bigint").alias("failures"),
        )
        for check, column, source in checks
    ]
    return one_row.select(F.inline(F.array(*lines)))


def _failing(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def check_columns(
    df: DataFrame,
    model: str,
    not_null: Sequence[str] = (),
    accepted_values: Mapping[str, Sequence[str]] | None = None,
    accepted_range: Mapping[str, tuple[float | None, float | None]] | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Row-wise checks of one table in one scan: no nulls, values from a list, values within (low, high)."""
    failing: list[tuple[str, str, Column]] = [("not_null", c, F.col(c).isNull()) for c in not_null]
    for c, values in (accepted_values or {}).items():
        failing.append(("accepted_values", c, ~F.col(c).isin(*values)))
    for c, (low, high) in (accepted_range or {}).items():
        outside = F.lit(False)
        if low is not None:
            outside = outside | ((F.col(c) < low) if inclusive else (F.col(c) <= low))
        if high is not None:
            outside = outside | ((F.col(c) > high) if inclusive else (F.col(c) >= high))
        failing.append(("accepted_range", c, outside))
    totals = df.agg(*[_failing(condition).alias(f"f{i}") for i, (_, _, condition) in enumerate(failing)])
    return _rows(totals, model, [(check, c, f"f{i}") for i, (check, c, _) in enumerate(failing)])


def check_unique(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Number of non-null values that occur more than once, for each column."""
    cells = [F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("cell")) for i, c in enumerate(columns)]
    repeated = (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("cell").isNotNull())
        .groupBy("i", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    totals = repeated.agg(*[_failing(F.col("i") == i).alias(f"f{i}") for i in range(len(columns))])
    return _rows(totals, model, [("unique", c, f"f{i}") for i, c in enumerate(columns)])


def check_grain(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Number of column combinations that occur more than once: is the table at the grain it claims?"""
    repeated = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    totals = repeated.agg(F.count(F.lit(1)).alias("f0"))
    return _rows(totals, model, [("grain", ", ".join(columns), "f0")])


def check_relationships(
    child: DataFrame, model: str, column: str, parent: DataFrame, field: str, strict: bool = False
) -> DataFrame:
    """Number of child rows whose key is not in the parent.

    A null child key passes, so a key that a left join failed to find goes unnoticed; ``strict`` counts it too.
    Child rows are counted per key before the join, so a hot key crosses the network as one row per task.
    """
    keys = child.groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    if not strict:
        keys = keys.where(F.col("_key").isNotNull())
    orphans = keys.join(parent.select(F.col(field).alias("_key")), "_key", "left_anti")
    totals = orphans.agg(F.sum("n").alias("f0"))
    return _rows(totals, model, [("relationships_strict" if strict else "relationships", column, "f0")])


def check_freshness(
    df: DataFrame,
    model: str,
    column: str,
    as_of: datetime,
    warn_after: timedelta | None = None,
    error_after: timedelta | None = None,
) -> DataFrame:
    """Age of the newest row at ``as_of``: model, column_name, age_seconds and status PASS, WARN or ERROR."""
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp")
    newest = df.agg(F.max(F.col(column)).alias("newest"))
    age = (F.unix_micros(now) - F.unix_micros(F.col("newest").cast("timestamp"))) / F.lit(1_000_000)
    status = F.when(F.col("age_seconds").isNull(), F.lit("ERROR"))
    if error_after is not None:
        status = status.when(F.col("age_seconds") > error_after.total_seconds(), F.lit("ERROR"))
    if warn_after is not None:
        status = status.when(F.col("age_seconds") > warn_after.total_seconds(), F.lit("WARN"))
    return newest.select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), age.alias("age_seconds")
    ).withColumn("status", status.otherwise(F.lit("PASS")))


def dq_report(checks: Iterable[DataFrame], warnings: Iterable[DataFrame] = ()) -> DataFrame:
    """All checks in one frame, with a status: PASS without failures, else ERROR, or WARN for those in ``warnings``."""
    graded = [df.withColumn("_grade", F.lit("ERROR")) for df in checks]
    graded += [df.withColumn("_grade", F.lit("WARN")) for df in warnings]
    every = reduce(DataFrame.unionByName, graded)
    status = F.when(F.col("failures") == 0, F.lit("PASS")).otherwise(F.col("_grade"))
    return every.withColumn("status", status).drop("_grade")


def enforce(report: DataFrame) -> dict[str, int]:
    """Run a report; return how many checks ended PASS, WARN and ERROR, or raise ``ChecksFailed`` naming the errors."""
    lines = report.collect()  # one row per declared check
    failed = [line for line in lines if line["status"] == "ERROR"]
    if failed:
        what = "; ".join(
            f"{r['check_name']} {r['model']}.{r['column_name']}: {r['failures']} failures" for r in failed
        )
        raise ChecksFailed(what)
    totals = {status: sum(line["status"] == status for line in lines) for status in ("PASS", "WARN", "ERROR")}
    return {**totals, "TOTAL": len(lines)}
