"""Compare a Spark query with its DuckDB twin, row by row and regardless of order."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(item) for item in value)
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str | None:
    """None where both give the same rows, else what differs."""
    names, got = rows_of(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    result = connection.execute(sql)
    twin_names, want = rows_of([d[0] for d in result.description], result.fetchall())
    if names != twin_names:
        return f"columns {names} against {twin_names}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows against {sum(want.values())}; "
            f"extra {list(extra.items())[:3]}, missing {list(missing.items())[:3]}"
        )
    return None
