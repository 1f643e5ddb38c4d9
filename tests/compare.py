"""Spark results against DuckDB on the same trial tables."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or isinstance(value, (bool, str)):
        return (type(value).__name__, str(value))
    if isinstance(value, float) and math.isnan(value):
        return ("number", "nan")
    return ("number", repr(float(value)))


def rows(names: list[str], records: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in records)


def differences(df, con, sql: str) -> list[str]:
    """What differs, as text; empty when column names, row count and every value agree."""
    con_result = con.execute(sql)
    expected_names = [d[0] for d in con_result.description]
    expected = rows(expected_names, con_result.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    found = []
    if sorted(df.columns) != sorted(expected_names):
        found.append(f"columns {sorted(df.columns)} != {sorted(expected_names)}")
    if len(got) != len(expected):
        found.append(f"rows {len(got)} != {len(expected)}")
    if not found and got != expected:
        found += [f"{a} != {b}" for a, b in zip(got, expected, strict=True) if a != b][:5]
    return found
