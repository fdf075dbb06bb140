"""Compare a Spark frame with a DuckDB result, regardless of row order."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

SMALL = "/root/testdata/sf0.001"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql: str) -> list:
    """Empty when both sides have the same columns and the same rows, value for value."""
    wanted = connection.sql(sql)
    if sorted(frame.columns) != sorted(wanted.columns):
        return [("columns", sorted(frame.columns), sorted(wanted.columns))]
    ours = rows_of(frame.columns, frame.collect())
    theirs = rows_of(wanted.columns, wanted.fetchall())
    return [("spark only", r) for r in list((ours - theirs))[:3]] + [
        ("oracle only", r) for r in list((theirs - ours))[:3]
    ]
