"""Declared source tables: the only names that staging may read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Source name -> namespace and tables.
DECLARED = {"raw": ("raw", ("inpatient_charges", "hrrp_readmissions"))}


def source(spark: SparkSession, name: str, table: str) -> DataFrame:
    """The declared source table; an undeclared name is an error, not a guess."""
    namespace, tables = DECLARED.get(name, (None, ()))
    if table not in tables:
        raise KeyError(f"source {name}.{table} is not declared")
    return spark.table(f"{namespace}.{table}")
