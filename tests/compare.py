"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: [(x is None, str(x)) for x in r]
    )


def differences(spark, con, folder: str, query, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    df = query(spark, folder)
    ours = _rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = _rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(ours)} rows differ, first: {bad[0]}"
    types = [type(a) is not type(b) and a is not None and b is not None for r in zip(ours, theirs) for a, b in zip(*r)]
    return "types differ" if any(types) else None
