"""Checks on tables: counts, keys, columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_counts(**tables: DataFrame) -> DataFrame:
    """Rows per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def key_diff(left: DataFrame, right: DataFrame, key: str, left_name: str = "left", right_name: str = "right") -> DataFrame:
    """Keys found on one side only, with the name of that side."""
    l = left.select(key).distinct().withColumn("__l", F.lit(True))
    r = right.select(key).distinct().withColumn("__r", F.lit(True))
    side = F.when(F.col("__r").isNull(), F.lit(left_name)).otherwise(F.lit(right_name))
    return (
        l.join(r, on=key, how="full")
        .where(F.col("__l").isNull() | F.col("__r").isNull())
        .select(key, side.alias("found_in"))
    )


def duplicate_columns(df: DataFrame) -> DataFrame:
    """Column names, how often each occurs (case ignored) and how many values they hold.

    One aggregate over the rows; most frequent names first.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    counted = plain.agg(*[F.count(F.col(c)).alias(c) for c in plain.columns])
    cells = F.array(*[F.struct(F.lit(n.lower()).alias("column_name"), F.col(c).alias("n")) for n, c in zip(names, plain.columns)])
    return (
        counted.select(F.inline(cells))
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("copies"), F.sum("n").alias("non_null"))
        .orderBy(F.desc("copies"), "column_name")
    )


def column_profile(df: DataFrame, keys: list[str]) -> DataFrame:
    """The feature columns in order, with rows and NULLs, from one aggregate."""
    features = [c for c in df.columns if c not in keys]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(F.col(c)).alias(c) for c in features])
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), (F.col("n_rows") - F.col(c)).alias("n_null"))
            for i, c in enumerate(features)
        ]
    )
    return counted.select("n_rows", F.inline(cells)).select("position", "feature", "n_rows", "n_null")
