"""Plain files: CSV landing folders and small result snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_landing(df: DataFrame, path: str, compression: str = "gzip", mode: str = "overwrite") -> None:
    """A folder of CSV files, each with the header; compressed files are read back as they are."""
    writer = df.write.mode(mode).options(header=True, quote='"', escape='"', compression=compression)
    writer.csv(path)


def save_result(df: DataFrame, folder: str, name: str) -> None:
    """The answer to a question as Parquet; small partitions are joined, so a few rows are one file."""
    df.hint("rebalance").write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")
