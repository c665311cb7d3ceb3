"""Strict comparison of a Spark result with a DuckDB result: same columns, same rows, same values."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~null"
    if isinstance(v, float):
        return repr(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str:
    """Empty when equal, else a short account of the difference."""
    names, left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    other, right = rows_of([d[0] for d in found.description], found.fetchall())
    if names != other:
        return f"columns {names} / {other}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} rows differ: {wrong[:2]}" if wrong else ""
