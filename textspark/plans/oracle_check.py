"""Side-by-side check of a registered query against its DuckDB oracle.

Mirrors the correctness gate: same column names, same row count, same
multiset of rows (order-insensitive). Used by tests and by the local script.
"""

from __future__ import annotations

import math
from collections import Counter

from ..sources.tables import TABLES, table_path


def _norm(v, digits=6):
    if v is None:
        return None
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits)
    if isinstance(v, int):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True), digits)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create or replace view {t} as select * from read_parquet('{table_path(sf_dir, t)}')")
    return con


def compare(spark, sf_dir: str, name: str, fn, sql: str, con=None) -> dict:
    con = con or duck_connection(sf_dir)
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in sdf.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_raw = cur.fetchall()
    order = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    d_rows = [tuple(_norm(r[i]) for i in order) for r in d_raw]
    res = {
        "name": name,
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
    }
    cs, cd = Counter(s_rows), Counter(d_rows)
    res["values_match"] = cs == cd
    if not res["values_match"]:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        res["sample_spark_only"] = only_s
        res["sample_oracle_only"] = only_d
    if not res["columns_match"]:
        res["spark_columns"] = s_cols
        res["oracle_columns"] = d_cols
    res["ok"] = res["columns_match"] and res["values_match"] and len(s_rows) == len(d_rows)
    return res
