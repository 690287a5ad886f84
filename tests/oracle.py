"""Side-by-side run of a registered query and its SQL on the same parquet tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf}/{t}.parquet").exists():
            con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
        return float(v)
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def differences(spark, con, sf, fn, sql) -> str | None:
    """None if both sides agree, else a short description of the first difference."""
    df = fn(spark, sf)
    got_cols, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; only here {list(set(got) - set(want))[:2]}; only SQL {list(set(want) - set(got))[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}" if bad else None
