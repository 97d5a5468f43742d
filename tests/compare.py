"""Compare a query with its SQL: columns, row count and values, whatever the row order."""

from __future__ import annotations

import datetime
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return ("dec", str(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def rows_by_name(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str | None:
    """None if both agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns: {sorted(df.columns)} against {sorted(names)}"
    want, got = rows_by_name(names, result.fetchall()), rows_by_name(df.columns, df.collect())
    if want == got:
        return None
    more, less = list((got - want).items())[:2], list((want - got).items())[:2]
    return f"{sum(got.values())} rows against {sum(want.values())}; only ours {more}; only SQL {less}"
