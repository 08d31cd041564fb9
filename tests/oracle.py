"""Comparing a query with its SQL on the same tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings feeds grupos areas rules arquivo subs pesos".split()


def connect(d: str):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{d}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    return con


def _text(v) -> str:
    if hasattr(v, "tolist") and not isinstance(v, bytes):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_text, v)) + "]"
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return "NULL"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def rows(df: pd.DataFrame) -> list[tuple[str, ...]]:
    df = df[sorted(df.columns)]
    return sorted(tuple(map(_text, r)) for r in df.itertuples(index=False, name=None))


def same(spark, con, d: str, query, sql: str) -> None:
    got, want = query(spark, d).toPandas(), con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows(got), rows(want)
    assert len(a) == len(b)
    assert a == b, (sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3])
