"""Compares a registered query with its SQL counterpart in DuckDB."""

import os
from collections import Counter

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in sorted(os.listdir(folder)):
        db.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{folder}/{name}')")
    return db


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


def same(df, db: duckdb.DuckDBPyConnection, sql: str) -> None:
    db.execute(f"CREATE OR REPLACE TEMP VIEW oracle AS {sql}")  # the SQL must stand as a view
    found = db.execute("SELECT * FROM oracle")
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    want = Counter(tuple(map(plain, r)) for r in found.fetchall())
    got = Counter(tuple(map(plain, r)) for r in df.select(*names).collect())
    assert got == want, list((got - want).items())[:3] + list((want - got).items())[:3]
