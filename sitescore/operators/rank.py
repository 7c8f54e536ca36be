"""Ranking sites by one score or by a weighted mix of scaled metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Weights of the scaled metrics; the price is a cost.
DEFAULT_WEIGHTS = {"stars_score": 2.0, "median_sales_volume_local": 1.0, "price": -2.0, "size_sqft": 0.5}
TOP = 3


def rank(df: DataFrame, score: str, key: str = "site_id", ascending: bool = False) -> DataFrame:
    """Order by score, NULL scores last, ties by key."""
    order = F.asc_nulls_last(score) if ascending else F.desc_nulls_last(score)
    return df.orderBy(order, F.asc(key))


def top_k(df: DataFrame, score: str, k: int = TOP, key: str = "site_id") -> DataFrame:
    return rank(df, score, key).limit(k)


def with_attributes(ranked: DataFrame, attributes: DataFrame, score: str, key: str = "site_id") -> DataFrame:
    """Ranked rows with their attributes; sites without attributes stay."""
    return rank(ranked.join(attributes, on=key, how="left"), score, key)


def winners(df: DataFrame, attributes: DataFrame, score: str, display: Sequence[str], k: int = TOP, key: str = "site_id") -> DataFrame:
    """The k best with the columns to show."""
    best = top_k(df.select(key, score), score, k, key)
    return rank(best.join(attributes, on=key).select(key, score, *display), score, key)


def min_max(df: DataFrame, columns: Sequence[str], prefix: str = "adj_") -> DataFrame:
    """Add each column scaled to 0..1 over all rows; NULL where all values are equal.

    The extrema are a one-row aggregate read as a scalar.
    """
    limits = df.agg(F.struct(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]).alias("limits")).scalar()
    with_limits = df.withColumn("__limits", limits)
    scaled = {
        f"{prefix}{c}": F.try_divide(
            (F.col(c) - F.col(f"__limits.min_{c}")).cast("double"),
            (F.col(f"__limits.max_{c}") - F.col(f"__limits.min_{c}")).cast("double"),
        )
        for c in columns
    }
    return with_limits.withColumns(scaled).drop("__limits")


def combined_score(df: DataFrame, weights: Mapping[str, float] | None = None, key: str = "site_id") -> DataFrame:
    """Weighted sum of the scaled metrics, best first; a NULL metric gives a NULL score."""
    weights = dict(DEFAULT_WEIGHTS if weights is None else weights)
    scaled = min_max(df, list(weights))
    score = None
    for column, weight in weights.items():
        term = F.lit(float(weight)) * F.col(f"adj_{column}")
        score = term if score is None else score + term
    return rank(scaled.withColumn("score", score).select(key, "score", *weights), "score", key)
