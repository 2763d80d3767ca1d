"""Runs a registered query and its SQL and compares the rows."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canon(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return f"b{v}"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"f{v!r}"
    if isinstance(v, int):
        return f"i{v}"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return f"{type(v).__name__}:{v}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark, con, sf, query, sql):
    """None if both agree, else a short report; also the row count."""
    df = query(spark, sf)
    names, got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    want_names, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if names != want_names:
        return f"columns {names} != {want_names}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; got {got[:2]} want {want[:2]}", len(got)
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        g, w = bad[0]
        diff = [(n, a, b) for n, a, b in zip(names, g, w) if a != b]
        return f"{len(bad)} rows differ, first: {diff}", len(got)
    return None, len(got)
