"""Run registered Spark queries and their DuckDB twins; compare results.

Comparison: same column names (sorted), same row count, and the same
multiset of rows after normalising values (dates to ISO text, floats to
9 significant digits, NaN/None to null).
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
        "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, (dt.datetime,)):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, tuples):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in tuples]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark, con, name, spark_fn, sql, sf_dir):
    sdf = spark_fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}")
        return problems, len(s_rows), len(d_rows)
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        sa, sb = set(a), set(b)
        only_s = list(sa - sb)[:3]
        only_d = list(sb - sa)[:3]
        problems.append(f"values differ; spark-only {only_s} duck-only {only_d}")
    return problems, len(s_rows), len(d_rows)
