"""Runs a query and its SQL twin and compares the rows."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(round(value, 6) + 0.0)
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_table(df: DataFrame):
    return table(df.columns, [tuple(r) for r in df.collect()])


def duck_table(connection, text: str):
    result = connection.execute(text)
    columns = [c[0] for c in result.description]
    return table(columns, result.fetchall())


def differences(spark: SparkSession, connection, folder: str, query, text: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    df = query(spark, folder)
    columns, rows = spark_table(df)
    other_columns, other_rows = duck_table(connection, text)
    if columns != other_columns:
        return f"columns {columns} / {other_columns}"
    if len(rows) != len(other_rows):
        return f"rows {len(rows)} / {len(other_rows)}; first {rows[:2]} / {other_rows[:2]}"
    wrong = [(a, b) for a, b in zip(rows, other_rows) if a != b]
    if wrong:
        return f"{len(wrong)} rows differ of {len(rows)}, e.g. {wrong[0]}"
    return None
