"""Joining addresses and sites with the tables that describe them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescore.operators.balance import FIND, balanced_join


@dataclass(frozen=True)
class FeatureSource:
    """A table of features and how it is keyed.

    ``on`` maps the key column of the enriched rows to the key column of the
    source. ``other_keys`` are columns that are neither key nor feature.
    ``one_row_per_key`` promises a unique key; it is checked while the source is
    read for a combined profile.
    """

    name: str
    frame: DataFrame
    on: tuple[str, str] = ("addr_id", "addr_id")
    other_keys: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    rename: dict[str, str] = field(default_factory=dict)
    one_row_per_key: bool = False

    def clean(self) -> DataFrame:
        """The source without its unwanted columns and with its final names."""
        return self.frame.drop(*self.drop).withColumnsRenamed(self.rename)

    def features(self) -> list[str]:
        skip = {self.on[1], *self.other_keys}
        return [c for c in self.clean().columns if c not in skip]

    def keyed(self, columns: Sequence[str] | None = None) -> DataFrame:
        """(left key name, columns or all), ready for a join on the left key name."""
        left_key, right_key = self.on
        rows = self.clean()
        wanted = [c for c in rows.columns if c != right_key] if columns is None else list(columns)
        return rows.select(F.col(right_key).alias(left_key), *wanted)

    def unique(self, columns: Sequence[str] | None = None) -> DataFrame:
        """``keyed`` rows, failing the query if a key occurs twice.

        The check groups on the join key, so it shares the join's shuffle.
        """
        df = self.keyed(columns)
        key = self.on[0]
        rest = [c for c in df.columns if c != key]
        grouped = (
            df.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.count(F.lit(1)).alias("__n"), *[F.min(c).alias(c) for c in rest])
        )
        twice = F.raise_error(F.concat(F.lit(f"{self.name}: key occurs twice: "), F.col(key).cast("string")))
        return grouped.where(F.when(F.col("__n") > 1, twice.cast("boolean")).otherwise(F.lit(True))).drop("__n")


def enrich(
    df: DataFrame,
    source: FeatureSource,
    columns: Sequence[str] | None = None,
    keep_key_as: str | None = None,
    hot: DataFrame | str | None = FIND,
) -> DataFrame:
    """Left join of a source on its key; ``keep_key_as`` keeps the source's key too.

    ``df`` may have a few very frequent keys.
    """
    right = source.keyed(columns)
    if keep_key_as is not None:
        right = right.withColumn(keep_key_as, F.col(source.on[0]))
    return balanced_join(df, right, source.on[0], how="left", right_unique=source.one_row_per_key, hot=hot)


def with_property_type(bridge: DataFrame, fabric: DataFrame) -> DataFrame:
    """Attach the property type of every address; unknown addresses stay."""
    return balanced_join(bridge, fabric.select("addr_id", "prop_type"), "addr_id", how="left")


def split_property(bridge: DataFrame, fabric: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(residential, business) rows; addresses of unknown type are in neither."""
    typed = with_property_type(bridge, fabric)
    return typed.where(F.col("prop_type") == "R"), typed.where(F.col("prop_type") == "B")


def property_counts(typed: DataFrame) -> DataFrame:
    """Residential and business rows in one row, from one pass."""
    return typed.agg(
        F.count_if(F.col("prop_type") == "R").alias("n_res"),
        F.count_if(F.col("prop_type") == "B").alias("n_bus"),
    )


def resolve_addresses(
    bridge: DataFrame, fabric: DataFrame, prop_type: str | None = None, hot: DataFrame | str | None = FIND
) -> DataFrame:
    """Distinct (site, property type, address, zip code, block group) rows.

    Addresses without property type drop out, so the join is an inner one.
    """
    known = fabric.select("addr_id", "prop_type", "zipcode", "geoid").distinct()
    known = known.where(F.col("prop_type").isNotNull() if prop_type is None else F.col("prop_type") == prop_type)
    narrow = bridge.select("site_id", "addr_id").where(F.col("site_id").isNotNull())
    joined = balanced_join(narrow, known, "addr_id", distinct_left=True, right_unique=True, hot=hot)
    return joined.select("site_id", "prop_type", "addr_id", "zipcode", "geoid")


def address_profile(fabric: DataFrame, sources: Sequence[FeatureSource], columns: dict[str, list[str]], keep: Sequence[str] = ()) -> DataFrame:
    """One row per fabric row with the chosen columns of all sources.

    The sources meet at the address table, which is far smaller than the rows
    of all fences, so those are shuffled once and not once per source. Sources
    keyed like the address come first and share one partitioning.
    """
    profile = fabric
    for source in sorted(sources, key=lambda s: s.on[0] != "addr_id"):
        right = source.unique(columns[source.name])
        if source.on[0] == "addr_id":
            profile = profile.join(right, on="addr_id", how="left")
        else:
            profile = balanced_join(profile, right, source.on[0], how="left", right_unique=True, left_by=["addr_id"])
    return profile.select("addr_id", *keep, *[c for s in sources for c in columns[s.name]])
