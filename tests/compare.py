"""Compare a Spark result with DuckDB's, regardless of row order."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return connection


def _value(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(
        hashlib.md5("|".join(_value(row[i]) for i in order).encode()).hexdigest() for row in rows
    )


def differences(spark_df, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when names, simple types, row count and values agree."""
    relation = connection.sql(sql)
    names = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "boolean": "BOOLEAN"}
    mine = {f.name: names.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if mine != theirs:
        return f"schema {mine} != {theirs}"
    left = rows_of(spark_df.columns, spark_df.collect())
    right = rows_of(relation.columns, relation.fetchall())
    if left == right:
        return ""
    missing = sum((right - left).values())
    extra = sum((left - right).values())
    return f"rows {sum(left.values())} != {sum(right.values())}; {extra} extra, {missing} missing"
