"""Compare Spark results with DuckDB results on the same tables."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, (decimal.Decimal, int, float)) and not isinstance(v, bool):
        return f"{float(v):.6f}"
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, run, sql):
    """(spark rows, sql rows, first differences)"""
    df = run(spark, folder)
    left = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns), (sorted(names), sorted(df.columns))
    right = rows_of(names, cur.fetchall())
    if left == right:
        return len(left), len(right), []
    a, b = set(left), set(right)
    return len(left), len(right), [sorted(a - b)[:3], sorted(b - a)[:3]] if a != b else ["multiplicity"]
