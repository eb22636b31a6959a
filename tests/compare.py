"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import duckdb

STAR = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in STAR:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canon(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return str(value)


def table(columns, rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canon(r[i]) for i in order) for r in rows)


def spark_table(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def duck_table(con, sql):
    cur = con.execute(sql)
    return table([d[0] for d in cur.description], cur.fetchall())


def diff(a, b) -> str | None:
    if a[0] != b[0]:
        return f"columns {a[0]} / {b[0]}"
    if a[1] == b[1]:
        return None
    from collections import Counter

    left, right = Counter(a[1]), Counter(b[1])
    return f"rows {len(a[1])}/{len(b[1])}; {list((left - right))[:3]} / {list((right - left))[:3]}"
