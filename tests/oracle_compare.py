"""Compare a Spark DataFrame with a DuckDB query, order-insensitively.

Mimics the driver's gate: same column names, same row count, and the
same multiset of normalised row values.  Normalisation: Decimal -> float,
floats rounded to 6 significant decimals, dates/timestamps -> ISO text,
NaN -> None, lists/arrays -> tuples.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

DRIVER_VIEWS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                "events", "documents", "embeddings", "pages", "benchmark", "labels",
                "conversations")


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in DRIVER_VIEWS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%dT%H:%M:%S.%f")
    if isinstance(v, dt.date):
        return v.strftime("%Y-%m-%dT00:00:00.000000")
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: repr(t))
    return [cols[i] for i in order], out


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    sc, sr = _rows(s_cols, s_rows)
    dc, dr = _rows(d_cols, d_rows)
    res = {"spark_rows": len(sr), "oracle_rows": len(dr), "columns_match": sc == dc,
           "values_match": sc == dc and sr == dr}
    if not res["values_match"]:
        res["spark_cols"], res["oracle_cols"] = sc, dc
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        res["only_spark"], res["only_oracle"] = diff_s, diff_d
    return res
