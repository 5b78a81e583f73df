"""Compare a Spark result with a SQL result: column names, kinds of types, and the set of rows."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        value = round(value, 6)
        return 0.0 if value == 0 else value
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    return value


def kind(value) -> str:
    return "-" if value is None else type(value).__name__


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, db, sql: str) -> str | None:
    """None when equal, else what differs."""
    names, mine = as_rows(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(sql)
    theirs_names, theirs = as_rows([c[0] for c in result.description], result.fetchall())
    if names != theirs_names:
        return f"columns {sorted(set(names) ^ set(theirs_names))}"
    for i, name in enumerate(names):
        kinds = [{kind(r[i]) for r in side} - {"-"} for side in (mine, theirs)]
        if kinds[0] and kinds[1] and kinds[0] != kinds[1]:
            return f"type of {name}: {kinds}"
    if mine != theirs:
        extra, missing = mine - theirs, theirs - mine
        return f"{sum(extra.values())} extra, {sum(missing.values())} missing of {sum(theirs.values())}: {list(extra)[:2]} / {list(missing)[:2]}"
    if not mine:
        return "both sides are empty"
    return None
