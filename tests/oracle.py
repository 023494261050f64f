"""Comparison of a query's rows with those of its SQL twin."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def connect(data: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in os.listdir(data):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{data}/{f}'")
    return c


def rows_of(frame) -> tuple[list[str], list[tuple]]:
    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(plain, r)) for r in frame.select(*[f"`{c}`" for c in columns]).collect())


def rows_of_sql(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    columns = sorted(names)
    at = [names.index(c) for c in columns]
    return columns, sorted(tuple(plain(r[k]) for k in at) for r in result.fetchall())
