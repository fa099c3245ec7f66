"""Comparison of a Spark result with reference SQL run by DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def kind(value) -> str:
    return type(value).__name__ if value is not None else "-"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], [tuple(plain(r[i]) for i in order) for r in rows]


def difference(df, con, sql: str) -> str | None:
    """None if names, value kinds and rows agree, else a short description."""
    mine_cols, mine = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    other_cols, other = rows_of(names, cursor.fetchall())
    if mine_cols != other_cols:
        return f"columns {mine_cols} != {other_cols}"
    if len(mine) != len(other):
        return f"{len(mine)} rows != {len(other)}"
    # 1 == 1.0 in Python, so the kinds are part of the comparison
    left = Counter(tuple((kind(v), v) for v in r) for r in mine)
    right = Counter(tuple((kind(v), v) for v in r) for r in other)
    if left != right:
        a, b = list((left - right))[:2], list((right - left))[:2]
        return f"{sum((left - right).values())} rows differ of {len(mine)}:\n  spark  {a}\n  oracle {b}"
    return None
