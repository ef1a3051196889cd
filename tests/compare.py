"""Run a registered query on both engines and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
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


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else float(repr(v))
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, [tuple(plain(r[c]) for c in cols) for r in df.collect()]


def oracle_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(plain(r[i]) for i in order) for r in cur.fetchall()]


def difference(df, con, sql) -> str | None:
    c1, r1 = spark_rows(df)
    c2, r2 = oracle_rows(con, sql)
    if c1 != c2:
        return f"columns {c1} != {c2}"
    a, b = Counter(r1), Counter(r2)
    if a == b:
        return None
    only1, only2 = list((a - b).elements()), list((b - a).elements())
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return (
        f"{len(r1)} vs {len(r2)} rows, {len(only1)}/{len(only2)} unmatched, columns {c1}\n"
        f"  spark  {sorted(only1, key=key)[:3]}\n  oracle {sorted(only2, key=key)[:3]}"
    )
