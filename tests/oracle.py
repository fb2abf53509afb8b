"""Compare a query with its reference SQL: columns by name, rows as a multiset, floats to nine digits."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return float(f"{value:.9g}")
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return float(f"{value:.15g}")
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _multiset(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cur = con.execute(sql)
    sql_names = [d[0] for d in cur.description]
    want = _multiset(sql_names, cur.fetchall())
    got_names = df.columns
    if sorted(n.lower() for n in sql_names) != sorted(n.lower() for n in got_names):
        return f"columns {sorted(got_names)} != {sorted(sql_names)}"
    got = _multiset(got_names, [tuple(row) for row in df.collect()])
    if got == want:
        return None
    missing, extra = want - got, got - want
    return (
        f"rows {sum(got.values())} != {sum(want.values())}; "
        f"missing {list(missing.items())[:3]}; extra {list(extra.items())[:3]}"
    )
