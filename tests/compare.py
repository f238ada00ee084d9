"""Exact comparison of a Spark frame with a DuckDB result: columns by name, rows as a multiset."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, Decimal):
        return ("d", format(value, "f"))
    if isinstance(value, datetime):
        return ("t", value.isoformat())
    if isinstance(value, date):
        return ("D", value.isoformat())
    if isinstance(value, float):
        return ("f", repr(value))
    if isinstance(value, int):
        return ("i", value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    left, right = rows_of(df.columns, df.collect()), rows_of(names, want)
    if left == right:
        return None if want else "both empty"
    return (f"{sum(left.values())} rows vs {sum(right.values())}; only Spark: {list((left - right).items())[:2]}; "
            f"only SQL: {list((right - left).items())[:2]}")
