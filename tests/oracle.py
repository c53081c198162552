"""Compare a query with its oracle in DuckDB over the same files."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(_plain(r[i])) for i in order) for r in rows)


def compare(spark, con, folder, query, sql):
    """Empty text if both give the same columns and rows, else what differs."""
    got = query(spark, folder)
    rows = [tuple(r) for r in got.collect()]
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(got.columns) != sorted(columns):
        return f"columns {sorted(got.columns)} != {sorted(columns)}"
    a, b = normal(got.columns, rows), normal(columns, expected)
    if a != b:
        different = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return f"rows {len(a)} vs {len(b)}; first differences {str(different)[:600]}"
    return ""
