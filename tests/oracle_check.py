"""Compare a Spark query with its oracle SQL run in DuckDB.

Both results are collected as Python values and compared as multisets of
rows, with column names (and their order) and Python value types checked
too, so a decimal(29,4) vs decimal(38,4) slip or an int vs bigint year
shows up as a type or value difference rather than passing silently.
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("int", v)
    if isinstance(v, float):
        return ("float", round(v, 9))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    if v is None:
        return ("null", "")
    return (type(v).__name__, v)


def compare(spark_df, con, sql: str):
    """Return (ok, message)."""
    s_cols = spark_df.columns
    s_rows = [tuple(_norm(x) for x in r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    if list(s_cols) != list(d_cols):
        return False, f"columns differ: spark={s_cols} oracle={d_cols}"
    cs, cd = collections.Counter(s_rows), collections.Counter(d_rows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        return False, f"rows differ: spark={len(s_rows)} oracle={len(d_rows)}; spark-only {only_s}; oracle-only {only_d}"
    return True, f"{len(s_rows)} rows"
