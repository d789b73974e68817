"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in data)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names and rows agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours = rows(df.columns, (tuple(r) for r in df.collect()))
    theirs = rows(names, result.fetchall())
    if ours != theirs:
        return f"only here {list((ours - theirs).items())[:3]}, only SQL {list((theirs - ours).items())[:3]}"
    return None
