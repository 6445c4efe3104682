"""Run a query on Spark and its SQL on DuckDB and compare the rows as multisets."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from floatlake.gallery.queries import TABLES


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(normal(r[i]) for i in order) for r in rows)


def difference(df, con, sql) -> str | None:
    """None when both sides agree, else a short description."""
    left_names, left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    right_names, right = rows_of(names, cursor.fetchall())
    if left_names != right_names:
        return f"columns {left_names} <> {right_names}"
    if left != right:
        only_left, only_right = left - right, right - left
        return (f"{sum(left.values())} vs {sum(right.values())} rows, {sum(only_left.values())} differ:\n"
                f"  spark {list(only_left)[:2]}\n  sql   {list(only_right)[:2]}")
    return None
