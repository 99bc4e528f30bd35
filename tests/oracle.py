"""Comparison of Spark results with DuckDB results."""

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def duck_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def compare(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Assert equal columns and rows, order aside; returns the number of rows."""
    expected = connection.sql(sql)
    assert sorted(df.columns) == sorted(expected.columns)
    mine, theirs = rows_of(df.columns, df.collect()), rows_of(expected.columns, expected.fetchall())
    assert len(mine) == len(theirs), (len(mine), len(theirs))
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    assert not wrong, (len(wrong), wrong[:3])
    return len(mine)


def type_names(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[tuple]:
    """Columns whose type differs between the engines."""
    spark_names = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "string": "VARCHAR",
        "date": "DATE",
        "timestamp": "TIMESTAMP",
        "boolean": "BOOLEAN",
    }
    expected = dict(zip(*(lambda r: (r.columns, map(str, r.types)))(connection.sql(sql))))
    return [(c, t, expected.get(c)) for c, t in df.dtypes if spark_names.get(t) != expected.get(c)]
