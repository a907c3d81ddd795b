"""Run a query on Spark and its oracle on DuckDB and compare all rows."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, Decimal):
        raise TypeError(f"decimal value {v}: cast it in the query")
    if isinstance(v, float):
        return ("f", "nan" if math.isnan(v) else repr(v + 0.0))
    return (type(v).__name__, v if not isinstance(v, list) else tuple(v))


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = df.collect()
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = res.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    if not got:
        return "no rows"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return None
    return f"{sum((a - b).values())} of {len(got)} rows differ: {list((a - b))[:3]} against {list((b - a))[:3]}"
