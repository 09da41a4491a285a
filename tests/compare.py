"""Run a registered query and its SQL side by side and compare every value."""

from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _value(value):
    return value.normalize() if isinstance(value, Decimal) else value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(spark, connection, query, sql: str, sf_dir: str) -> list[str]:
    """Empty if the two results agree in columns, row count and values."""
    frame = query(spark, sf_dir)
    result = connection.sql(sql)
    if sorted(frame.columns) != sorted(result.columns):
        return [f"columns {sorted(frame.columns)} != {sorted(result.columns)}"]
    ours, theirs = _rows(frame.columns, frame.collect()), _rows(result.columns, result.fetchall())
    if not ours:
        return ["no rows"]
    if ours == theirs:
        return []
    return [f"only here: {list((ours - theirs).items())[:2]}", f"only in SQL: {list((theirs - ours).items())[:2]}"]
