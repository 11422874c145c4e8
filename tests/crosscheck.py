"""Run a registered query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "quantize"):
        value = float(value)
    if isinstance(value, (int, float)):
        number = round(float(value), 6)
        return number + 0.0
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def compare(name, spark, con, folder, queries, oracles):
    """None if equal, else a short description of the difference."""
    frame = queries[name](spark, folder)
    got_columns, got = rows_of(frame.columns, frame.collect())
    cursor = con.execute(oracles[name])
    want_columns, want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            diff = [(c, x, y) for c, x, y in zip(got_columns, a, b) if x != y]
            return f"first difference {str(diff)[:600]}"
    return None
