"""Compares a query with its SQL in DuckDB: rows without order, columns by name."""

import math
from collections import Counter

import duckdb

from sheaf.sources.views import TABLES


def connection(sf: str):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def value(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.6g}"
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, int):
        return f"{float(x):.6g}" if abs(x) < 10**5 else str(x)
    return str(x)


def differences(df, con, sql: str):
    names = sorted(df.columns)
    other = con.sql(sql)
    assert names == sorted(other.columns), (names, sorted(other.columns))
    ours = Counter(tuple(value(r[c]) for c in names) for r in df.collect())
    at = [other.columns.index(c) for c in names]
    theirs = Counter(tuple(value(r[k]) for k in at) for r in other.fetchall())
    return ours - theirs, theirs - ours
