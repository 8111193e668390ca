"""Compare a Spark result with DuckDB's for the same query, row for row."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _value(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime):
        return value.isoformat()
    return value


def _rows(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    values = [tuple(_value(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(values, key=repr)


def difference(df, connection, sql: str) -> str | None:
    """None when equal, else the first difference as text."""
    got_names, got = _rows(df.columns, df.collect())
    cursor = connection.execute(sql)
    want_names, want = _rows([c[0] for c in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{mine} != {theirs}"
    return None
