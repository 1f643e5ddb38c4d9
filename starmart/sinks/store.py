"""Tables as Parquet folders, optionally listed in the catalog."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def namespace_for(custom: str | None, default: str) -> str:
    """A model's own namespace is taken as it is written, without a prefix; without one the default holds."""
    return default if custom is None else custom.strip()


class Store:
    """Full-refresh tables under one root folder.

    Every save writes a fresh folder and only then points the name at it: a failed write leaves the previous
    table in place, and a table may be rebuilt from itself. Where the columns are as before, one statement points the
    name at the new folder. Earlier folders stay until they are cleaned up.
    """

    def __init__(self, spark: SparkSession, root: str, catalog: bool = True):
        self.spark = spark
        self.root = root.rstrip("/")
        self.catalog = catalog

    def save(self, df: DataFrame, namespace: str, name: str, cluster_by: Sequence[str] = ()) -> DataFrame:
        """Write ``df`` as table ``namespace.name`` and return a reader of it.

        ``cluster_by`` sorts the rows by range over the files, so that a filter on those columns skips most of
        them; it costs one shuffle of the table. End it in a key, so that a frequent value spans several files.
        """
        path = f"{self.root}/{namespace}/{name}/{uuid.uuid4().hex}"
        if cluster_by:
            df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        df.write.parquet(path)
        if self.catalog:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`")
            table = f"`{namespace}`.`{name}`"
            saved = self.spark.read.schema(df.schema).parquet(path)
            same = self.spark.catalog.tableExists(table) and self.spark.table(table).dtypes == saved.dtypes
            if same:
                # One statement: a reader finds the former table or this one, never none.
                self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
                self.spark.catalog.refreshTable(table)
            else:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
                self.spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
            return self.spark.table(f"{namespace}.{name}")
        return self.spark.read.schema(df.schema).parquet(path)

    def view(self, df: DataFrame, namespace: str, name: str) -> DataFrame:
        """Name a frame for this session, as ``namespace_name``, without computing it."""
        df.createOrReplaceTempView(f"{namespace}_{name}")
        return df

    def part_view(self, namespace: str, name: str, table: str, columns: Sequence[str], condition: str) -> None:
        """List some columns and rows of a saved table in the catalog as a view of its own."""
        if self.catalog:
            listed = ", ".join(f"`{c}`" for c in columns)
            self.spark.sql(
                f"CREATE OR REPLACE VIEW `{namespace}`.`{name}` AS "
                f"SELECT {listed} FROM `{namespace}`.`{table}` WHERE {condition}"
            )
