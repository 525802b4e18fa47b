"""Compare a Spark query with its DuckDB oracle, like the driver does:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "\x00null"
    if isinstance(v, float):
        if math.isnan(v):
            return "\x00null"
        return repr(round(v, 6))
    if hasattr(v, "item"):
        v = v.item()
    return repr(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for ln in lines:
        h.update(ln.encode())
        h.update(b"\n")
    return sorted(columns), len(lines), h.hexdigest()


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    s = digest(s_cols, s_rows)
    d = digest(d_cols, d_rows)
    return {"columns_match": s[0] == d[0], "rows": (s[1], d[1]),
            "hash_match": s[2] == d[2], "ok": s == d, "spark_cols": s[0], "duck_cols": d[0]}
