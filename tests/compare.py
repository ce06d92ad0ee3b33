"""Run a registered query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value: object) -> object:
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return f"{value:f}"
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    relation = con.sql(sql)
    theirs = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    expected = {name: KINDS.get(kind, kind.lower()) for name, kind in theirs.items()}
    actual = dict(df.dtypes)
    if expected != actual:
        return f"types differ: spark {actual}, sql {expected}"
    left, right = rows_of(df.columns, df.collect()), rows_of(relation.columns, relation.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows in spark, {len(right)} in sql"
    for a, b in zip(left, right):
        if a != b:
            return f"spark {a}, sql {b}"
    return None
