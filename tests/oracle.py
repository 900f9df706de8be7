"""Order-insensitive comparison of a Spark result with a DuckDB oracle."""

from __future__ import annotations

import hashlib
import math

import duckdb

from tollgate.plans.catalog import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def rows_digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(norm).encode()).hexdigest()
    return [columns[i] for i in order], norm, h


def compare(spark_df, con, sql):
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_cols = list(spark_df.columns)
    res = con.sql(sql)
    d_cols = list(res.columns)
    d_rows = res.fetchall()
    sc, sn, sh = rows_digest(s_cols, s_rows)
    dc, dn, dh = rows_digest(d_cols, d_rows)
    return {"cols_match": sc == dc, "rows": (len(sn), len(dn)), "hash_match": sh == dh,
            "spark_cols": sc, "duck_cols": dc, "spark_sample": sn[:3], "duck_sample": dn[:3]}
