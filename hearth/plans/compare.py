"""Local cross-check of a registered query against its DuckDB oracle.

Row count, column names and an order-insensitive hash of the values.
"""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(round(v, 9))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return repr(float(v)) if False else str(v)
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, con, key: str, entry, sf_dir: str) -> dict:
    sdf = entry.spark(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(entry.sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {
        "key": key,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "hash_match": digest(s_cols, s_rows) == digest(d_cols, d_rows),
    }
    out["ok"] = out["columns_match"] and out["hash_match"] and out["spark_rows"] == out["oracle_rows"]
    if not out["ok"]:
        out["spark_columns"], out["oracle_columns"] = s_cols, d_cols
    return out
