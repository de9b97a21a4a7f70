"""Runs queries beside their SQL and compares rows."""

from __future__ import annotations

import datetime
import math

import duckdb
import numpy as np

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _value(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, (bool, np.bool_)):
        return bool(x)
    if isinstance(x, (int, float, np.number)):
        return round(float(x), 6)
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    if isinstance(x, datetime.date):
        return x.isoformat()
    return x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(([_value(r[i]) for i in order] for r in data), key=repr)


def connect(sf_dir: str):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def same(df, con, sql: str) -> str:
    """'' if equal, else what differs."""
    mine = rows(df.columns, df.collect())
    found = con.sql(sql)
    other = rows(found.columns, found.fetchall())
    if mine[0] != other[0]:
        return f"columns {mine[0]} {other[0]}"
    if len(mine[1]) != len(other[1]):
        return f"rows {len(mine[1])} {len(other[1])}: {mine[1][:2]} {other[1][:2]}"
    bad = [(a, b) for a, b in zip(mine[1], other[1], strict=True) if a != b]
    return f"{len(bad)} of {len(mine[1])} differ: {bad[:2]}" if bad else ""
