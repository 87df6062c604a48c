"""Runs a named query in Spark and its SQL in DuckDB, and compares all rows."""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return collections.Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(result, connection, sql: str) -> list[str]:
    """What differs between a Spark result and the SQL's; empty when all is equal."""
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    expected = _rows(names, answer.fetchall())
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)}, expected {sorted(names)}"]
    found = _rows(result.columns, [tuple(r) for r in result.collect()])
    if not expected:
        return ["the SQL gives no rows"]
    return [
        *[f"missing {n} x {row}" for row, n in list((expected - found).items())[:5]],
        *[f"not expected {n} x {row}" for row, n in list((found - expected).items())[:5]],
    ]
