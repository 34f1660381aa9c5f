"""Row-by-row comparison of a Spark result with DuckDB's answer to the reference SQL."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()


def connect(folder: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    """Same Python value for the same SQL value of either engine; types stay apart."""
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        return ("float", repr(value))
    if isinstance(value, Decimal):
        return ("decimal", str(value.normalize()))
    if isinstance(value, datetime):
        return ("timestamp", value.replace(tzinfo=None).isoformat())
    if isinstance(value, date):
        return ("date", value.isoformat())
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, connection, sql: str) -> list[str]:
    """Empty when columns, types of values and all rows agree."""
    relation = connection.sql(sql)
    ours, theirs = sorted(df.columns), sorted(relation.columns)
    if ours != theirs:
        return [f"columns: {sorted(set(ours) ^ set(theirs))}"]
    left = rows_of(df.columns, df.collect())
    right = rows_of(relation.columns, relation.fetchall())
    if left == right:
        return []
    found = [f"rows: {sum(left.values())} and {sum(right.values())}, columns {ours}"]
    found += [f"only Spark: {row}" for row in list((left - right).elements())[:3]]
    found += [f"only SQL:   {row}" for row in list((right - left).elements())[:3]]
    return found
