"""Rows of a query against those of its SQL counterpart in DuckDB."""

from __future__ import annotations

import decimal
import glob
import math
import os
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 9) + 0.0
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    return x


def table_of(names: list[str], rows: list) -> list:
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


def differences(spark, query, sql: str, sf_dir: str) -> str:
    """Empty if both give the same columns and rows."""
    got = query(spark, sf_dir)
    con = views(sf_dir).execute(sql)
    names = [d[0] for d in con.description]
    want = con.fetchall()
    if sorted(got.columns) != sorted(names):
        return f"columns {sorted(got.columns)} and {sorted(names)}"
    a, b = table_of(got.columns, got.collect()), table_of(names, want)
    if a == b:
        return ""
    odd = [(x, y) for x, y in zip(a, b) if x != y][:1]
    return f"{len(a)} and {len(b)} rows; {str(odd)[:900]}"
