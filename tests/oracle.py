"""Compares a query's rows with its SQL on DuckDB."""

from __future__ import annotations

import datetime
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return datetime.datetime.combine(value, datetime.time()).isoformat()
    return round(float(value), 6)


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(plain(v) for v in row) for row in df.select(*names).collect()), key=repr)


def rows_of_duckdb(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted((tuple(plain(row[i]) for i in order) for row in cursor.fetchall()), key=repr)
