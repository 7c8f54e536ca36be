"""Projections, filters, null rules and deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def project(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.select(*keys, *[c for c in columns if c not in keys])


def with_constants(df: DataFrame, **constants: object) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def expand(df: DataFrame, column: str) -> DataFrame:
    """Replace a struct column by its fields."""
    return df.select("*", f"{column}.*").drop(column)


def request_map(**fields: Column) -> Column:
    """Map of request field name to text value."""
    return F.create_map(*[c for name, value in fields.items() for c in (F.lit(name), value.cast("string"))])


def keep_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def cast_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to double; text that is no number becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def keep_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return df.join(keys.select(on), on=on, how="left_semi")


def reject_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return df.join(keys.select(on), on=on, how="left_anti")


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """The smallest row of every key, columns compared from left to right, NULLs first.

    A minimum is combined before the shuffle, so a key with many rows costs
    nothing extra.
    """
    rest = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("__row"))
    return first.select(*[F.col(key) if c == key else F.col(f"__row.{c}").alias(c) for c in df.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def null_counts(df: DataFrame) -> dict[str, int]:
    """NULLs per column, from one aggregate."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    return row.asDict()


@dataclass(frozen=True)
class NullPolicy:
    """What to do with NULL features: ``zero`` fills numbers, ``drop_columns`` drops.

    ``fit`` decides on the training rows which columns to drop; ``apply`` does
    the same to any later rows.
    """

    kind: str = "zero"
    dropped: tuple[str, ...] = field(default=())

    def fit(self, df: DataFrame) -> NullPolicy:
        if self.kind == "zero":
            return self
        counts = null_counts(df)
        return NullPolicy(self.kind, tuple(c for c in df.columns if counts[c] > 0))

    def apply(self, df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
        """``keys`` are left as they are, which also keeps their partitioning."""
        if self.kind == "zero":
            return df.na.fill(0, subset=[c for c in numeric_columns(df) if c not in keys])
        return df.drop(*[c for c in self.dropped if c not in keys])
