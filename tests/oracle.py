"""Comparing a query with its SQL on the same tables."""

from __future__ import annotations

import datetime
import decimal
import math

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


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(plain, key=repr)


def spark_rows(frame):
    return _rows(frame.columns, [tuple(r) for r in frame.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    return _rows([d[0] for d in cursor.description], cursor.fetchall())


def assert_same(frame, con, sql):
    names, rows = spark_rows(frame)
    sql_names, expected = sql_rows(con, sql)
    assert names == sql_names
    assert len(rows) == len(expected)
    different = [(a, b) for a, b in zip(rows, expected, strict=True) if a != b]
    assert not different, different[:3]
