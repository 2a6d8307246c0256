"""Compares registered queries with their DuckDB statements: ``check_oracles.py [sf_dir] [names...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tidemark.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows with columns by name, values made comparable, in sorted order."""
    cols = sorted(df.columns)

    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and pd.isna(v)):
            return "∅"
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
        if hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        if isinstance(v, (bool,)):
            return str(v)
        if isinstance(v, float) and v == int(v):
            return str(int(v))
        return str(v)

    return sorted(tuple(plain(v) for v in row) for row in df[cols].astype(object).itertuples(index=False))


def compare(spark, con, folder: str, name: str) -> str:
    fn, sql = entry.queries()[name], entry.oracle_sql().get(name)
    got = fn(spark, folder).toPandas()
    if sql is None:
        return f"rows only: {len(got)}"
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"MISMATCH columns {sorted(got.columns)} / {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a != b:
        first = next((p for p in zip(a, b) if p[0] != p[1]), None)
        return f"MISMATCH {len(a)} / {len(b)} rows, first {str(first)[:1500]}"
    kinds = [
        (c, str(got[c].dtype), str(want[c].dtype)) for c in got.columns
        if got[c].dtype.kind != want[c].dtype.kind or got[c].dtype.itemsize != want[c].dtype.itemsize
    ]
    return f"ok {len(a)}" + (f" kinds {kinds}" if kinds else "")


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": 8, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in names:
        start = time.time()
        try:
            result = compare(spark, con, folder, name)
        except Exception as e:  # noqa: BLE001
            result = f"ERROR {type(e).__name__} {str(e)[:1200]}"
        print(f"{time.time() - start:6.1f}s {name}: {result}", flush=True)
