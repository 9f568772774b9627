"""Row-by-row comparison of a Spark result with the checking SQL."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, int):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark_frame, connection, sql: str) -> str | None:
    """None when columns and rows agree, else a short description."""
    cursor = connection.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    expected = bag(cursor.fetchall(), expected_columns)
    found = bag([tuple(r) for r in spark_frame.collect()], spark_frame.columns)
    if sorted(expected_columns) != sorted(spark_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(expected_columns)}"
    if expected != found:
        extra, lacking = found - expected, expected - found
        return (
            f"rows {sum(found.values())} vs {sum(expected.values())}; columns {sorted(expected_columns)}; "
            f"only spark {sum(extra.values())}: {list(extra)[:2]}; only sql {sum(lacking.values())}: {list(lacking)[:2]}"
        )
    return None
