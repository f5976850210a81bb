"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as _dt
import math
from collections import Counter

import duckdb

from arrivals.plans.queries import TABLES


# Digits doubles are rounded to before comparing; None compares exact values.
FLOAT_DIGITS: int | None = 6


def canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if FLOAT_DIGITS is None else round(v, FLOAT_DIGITS)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return canon(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return [tuple(canon(r[i]) for i in order) for r in rows], sorted(n.lower() for n in names)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(df, con, sql: str) -> tuple[bool, str]:
    s_rows, s_names = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    d_rows, d_names = rows_of([d[0] for d in cur.description], cur.fetchall())
    if s_names != d_names:
        return False, f"columns spark={s_names} duckdb={d_names}"
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs != cd:
        return False, (f"rows spark={len(s_rows)} duckdb={len(d_rows)}; spark-only {list((cs - cd).elements())[:3]}; "
                       f"duckdb-only {list((cd - cs).elements())[:3]}")
    return True, f"{len(s_rows)} rows"
