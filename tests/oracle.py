"""Compare a query with its SQL: column names, row count and values, whatever the row order."""

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def compare(df, connection, sql: str) -> str | None:
    """``None`` if they agree, else what differs."""
    expected = connection.execute(sql)
    names = [c[0] for c in expected.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} are not {sorted(names)}"
    order = sorted(names)
    want = sorted((tuple(_plain(r[names.index(c)]) for c in order) for r in expected.fetchall()), key=repr)
    got = sorted((tuple(_plain(r[c]) for c in order) for r in df.collect()), key=repr)
    if len(got) != len(want):
        return f"{len(got)} rows, not {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{mine} is not {theirs}"
    return None
