"""Compares a Spark result with the DuckDB result of its oracle, row by row."""

import math
from collections import Counter
from pathlib import Path

import duckdb


def oracle_rows(sql: str, folder: str):
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    return columns, result.fetchall()


def _normal(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_normal(row[i]) for i in order) for row in rows)


def differences(df, sql: str, folder: str):
    """Rows only in Spark, rows only in DuckDB, row count."""
    columns, expected = oracle_rows(sql, folder)
    assert sorted(df.columns) == sorted(columns)
    got = as_bag(df.columns, df.collect())
    want = as_bag(columns, expected)
    return got - want, want - got, sum(got.values())
