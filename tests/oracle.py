"""Compares a registered query with its SQL on DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else repr(value + 0.0))
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, datetime):
        return ("time", value.isoformat())
    if value is None:
        return ("null", None)
    return (type(value).__name__, value)


def differences(df, con, sql: str) -> list[str]:
    """What differs between a Spark result and an SQL result; empty when they are equal."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    order = sorted(names)
    want = Counter(tuple(_plain(row[names.index(c)]) for c in order) for row in expected)
    got = Counter(tuple(_plain(row[c]) for c in order) for row in df.collect())
    if want == got:
        return []
    out = [f"rows {sum(got.values())} instead of {sum(want.values())}"]
    out += [f"  expected {dict(zip(order, r))}" for r in list((want - got))[:3]]
    out += [f"  found    {dict(zip(order, r))}" for r in list((got - want))[:3]]
    return out
