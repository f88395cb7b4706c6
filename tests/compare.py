"""Running a query and its SQL counterpart over the same files."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def kind(type_name: str) -> str:
    name = type_name.lower()
    same = {
        "bigint": "long", "integer": "int", "varchar": "string", "hugeint": "hugeint",
        "timestamp_ntz": "timestamp", "timestamp with time zone": "timestamp",
    }
    return same.get(name, name)


def plain(value):
    return value.replace(tzinfo=None) if isinstance(value, dt.datetime) else value


def ordered(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns by name, in an order that does not depend on the engine."""
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in places) for row in rows), key=repr)


def spark_result(df):
    types = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    return types, ordered(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql: str):
    relation = con.sql(sql)
    types = {n: kind(str(t)) for n, t in zip(relation.columns, relation.types, strict=True)}
    return types, ordered(relation.columns, relation.fetchall())
