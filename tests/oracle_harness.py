"""Run a registered query on Spark and its oracle SQL on DuckDB, then compare.

Comparison mirrors the driver's gate: same column names, same row count, and
the same multiset of rows (order-insensitive; doubles compared with a small
relative tolerance, decimals as numbers).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, repr(round(x, 2)) if isinstance(x, float) else repr(x)) for x in row)


def rows_equal(a, b) -> bool:
    for x, y in zip(a, b):
        if isinstance(x, float) and isinstance(y, float):
            if not math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-6):
                return False
        elif x != y:
            return False
    return True


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.collect()]


def duck_rows(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    data = rel.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in data]


def compare(spark, query, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    s_cols, s_rows = spark_rows(query(spark, sf_dir))
    d_cols, d_rows = duck_rows(con, sql)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows), "columns_match": s_cols == d_cols}
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        out["match"] = False
        return out
    s_sorted, d_sorted = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    bad = [(a, b) for a, b in zip(s_sorted, d_sorted) if not rows_equal(a, b)]
    out["match"] = len(s_rows) == len(d_rows) and not bad
    if bad:
        out["first_diff"] = bad[0]
    return out
