"""Compare registered queries with their oracle SQL in DuckDB."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        if Path(folder, f"{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def compare(spark, con, folder: str, fn, sql: str) -> str | None:
    """None if equal, else what differs."""
    ours = fn(spark, folder)
    names = sorted(ours.columns)
    got = sorted((tuple(cell(r[c]) for c in names) for r in ours.collect()), key=repr)
    cur = con.execute(sql)
    theirs = [d[0] for d in cur.description]
    if sorted(theirs) != names:
        return f"columns {names} vs {sorted(theirs)}"
    at = [theirs.index(c) for c in names]
    want = sorted((tuple(cell(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    if not got:
        return "no rows"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    types = {c: t for c, t in zip(theirs, (str(d[1]) for d in cur.description))}
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, e.g. {names}: {wrong[0][0]} vs {wrong[0][1]}"
    kinds = dict(ours.dtypes)
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = [f"{c} {kinds[c]} vs {types[c]}" for c in names if same.get(kinds[c], kinds[c]) != types[c]]
    return f"TYPES {odd}" if odd else None
