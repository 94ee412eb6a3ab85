"""Compare a registered Spark query with its DuckDB oracle (order-insensitive)."""

from __future__ import annotations

import datetime as _dt
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, exact: bool):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(v) if exact else f"{v:.9g}")
    if isinstance(v, _dt.datetime):
        return (1, v.isoformat(sep=" "))
    if isinstance(v, _dt.date):
        return (1, v.isoformat())
    return (1, str(v))


def rows_of(cols, rows, exact):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i], exact) for i in order) for r in rows)


def compare(spark, name: str, query, sql: str, sf_dir: str, exact: bool = True) -> dict:
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "spark_cols": s_cols,
        "oracle_cols": d_cols,
    }
    out["values_match"] = out["cols_match"] and rows_of(s_cols, s_rows, exact) == rows_of(d_cols, d_rows, exact)
    if out["cols_match"] and not out["values_match"]:
        a = rows_of(s_cols, s_rows, exact)
        b = rows_of(d_cols, d_rows, exact)
        sa, sb = set(a), set(b)
        out["only_spark"] = [r for r in a if r not in sb][:3]
        out["only_oracle"] = [r for r in b if r not in sa][:3]
    return out
