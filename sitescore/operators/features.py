"""Collapsing the addresses around a site to one row of features."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescore.functions.measures import STATISTICS
from sitescore.operators.balance import FIND, balanced_join
from sitescore.operators.columns import NullPolicy, one_row_per_key
from sitescore.operators.enrich import FeatureSource, address_profile

POI_MEASURES = ("employee_here", "employee_count", "sales_volume_usd")


def feature_columns(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Columns that are no keys, in order; reads the schema only."""
    return [c for c in df.columns if c not in set(keys)]


def column_sets(left: Sequence[str], right: Sequence[str]) -> dict[str, list[str]]:
    """Sorted union and differences of two name lists."""
    l, r = set(left), set(right)
    return {"union": sorted(l | r), "left_only": sorted(l - r), "right_only": sorted(r - l)}


def sample_columns(
    sources: Sequence[FeatureSource], n: int | None = 5, drop_share: float | None = None, seed: int = 42
) -> dict[str, list[str]]:
    """Seeded choice of feature names, drawn source by source in the given order.

    Either ``n`` names per source or all but ``drop_share`` of them. One
    generator serves all sources, so leaving one out changes the later draws.
    """
    draw = random.Random(seed)
    chosen = {}
    for source in sources:
        names = source.features()
        size = n if drop_share is None else len(names) - int(drop_share * len(names))
        chosen[source.name] = draw.sample(names, size)
    return chosen


def feature_lineage(sources: Sequence[FeatureSource]) -> DataFrame:
    """Every feature with its source and the number of values it holds."""
    parts = []
    for source in sources:
        names = source.features()
        counted = source.keyed(names).agg(*[F.count(c).alias(c) for c in names])
        cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("non_null")) for c in names])
        parts.append(counted.select(F.inline(cells)).select("feature", F.lit(source.name).alias("source"), "non_null"))
    lineage = parts[0]
    for part in parts[1:]:
        lineage = lineage.unionByName(part)
    return lineage


def proximity_stats(
    rows: DataFrame, key: str, columns: Sequence[str], statistics: Sequence[str] = ("avg", "stddev", "min", "max", "median")
) -> DataFrame:
    """One row per key with ``{statistic}_{column}`` for all columns, in one pass."""
    return rows.groupBy(key).agg(*[STATISTICS[s](F.col(c)).alias(f"{s}_{c}") for s in statistics for c in columns])


def census_blocks(rows: DataFrame, key: str = "site_id", code: str = "code") -> DataFrame:
    """Distinct codes per key; a missing code counts as one more."""
    return rows.select(key, code).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("code_cnt"))


def assemble(spine: DataFrame, *parts: DataFrame, key: str = "site_id") -> DataFrame:
    """Left-join aggregates that have one row per key."""
    for part in parts:
        spine = spine.join(part, on=key, how="left")
    return spine


def residential(
    bridge: DataFrame,
    fabric: DataFrame,
    sources: Sequence[FeatureSource],
    columns: dict[str, list[str]],
    code_source: str,
    code: str = "code",
    prop_type: str = "R",
    hot: DataFrame | str | None = FIND,
) -> DataFrame:
    """Statistics of all chosen columns over the distinct residential addresses of a site.

    Sources with one row per key are joined to the address table first and
    collapsed together, the others are collapsed on their own. Blocks are
    counted over the ``code`` column of ``code_source``.
    """
    homes = fabric.where(F.col("prop_type") == prop_type).select("addr_id", "zipcode", "geoid")
    homes = homes.repartition("addr_id").distinct().drop("zipcode")
    narrow = bridge.select("site_id", "addr_id").where(F.col("site_id").isNotNull())
    wanted = {s.name: [*columns[s.name], *([code] if s.name == code_source else [])] for s in sources}
    together = [s for s in sources if s.one_row_per_key]
    groups = ([together] if together else []) + [[s] for s in sources if not s.one_row_per_key]

    parts, blocks = [], None
    for group in groups:
        if group[0].one_row_per_key:
            profile = address_profile(homes, group, wanted)
        else:
            source = group[0]
            left = balanced_join(homes, source.keyed(wanted[source.name]), source.on[0], how="left", left_by=["addr_id"])
            profile = left.select("addr_id", *wanted[source.name])
        unique = group[0].one_row_per_key
        rows = balanced_join(narrow, profile, "addr_id", distinct_left=True, right_unique=unique, hot=hot if unique else FIND)
        parts.append(proximity_stats(rows, "site_id", [c for s in group for c in columns[s.name]]))
        if any(s.name == code_source for s in group):
            blocks = census_blocks(rows, code=code)
    return assemble(parts[0], *parts[1:], blocks)


def poi_profile(poi: DataFrame, brand: str, group: str, brand_column: str = "brandname", group_column: str = "group_name") -> DataFrame:
    """Points of interest collapsed to one row per address.

    Sums and counts instead of averages, so that a site's figures follow by
    adding up its addresses and no address is multiplied by its points. Brand
    points are counted once per distinct row.
    """
    rows = poi.groupBy(*poi.columns).agg(F.count(F.lit(1)).alias("__copies"))
    copies = F.col("__copies")
    related = F.col(group_column) == group

    def added(column: str) -> list:
        value = F.when(related & F.col(column).isNotNull(), F.col(column) * copies)
        known = F.when(related & F.col(column).isNotNull(), copies).otherwise(F.lit(0))
        return [F.sum(value).alias(f"sum_{column}"), F.sum(known).alias(f"n_{column}")]

    return rows.where(F.col("addr_id").isNotNull()).groupBy("addr_id").agg(
        F.sum(copies).alias("n_all"),
        F.sum(F.when(related, copies).otherwise(F.lit(0))).alias("n_related"),
        F.sum(F.when(F.col(brand_column) == brand, 1).otherwise(0)).alias("n_brand"),
        *[c for measure in POI_MEASURES for c in added(measure)],
    )


def business_totals(
    bridge: DataFrame,
    fabric: DataFrame,
    poi: DataFrame,
    brand: str,
    group: str,
    prop_type: str = "B",
    distinct_bridge: bool = False,
    hot: DataFrame | str | None = FIND,
) -> DataFrame:
    """Sums and counts over the business points around each site.

    Counts are counts of joined rows: an address listed twice in the bridge
    counts twice unless ``distinct_bridge``.
    """
    shops = fabric.where(F.col("prop_type") == prop_type).select("addr_id")
    profile = shops.join(poi_profile(poi, brand, group), on="addr_id").groupBy("addr_id")
    sums = ["n_all", "n_related", "n_brand"] + [f"{p}_{c}" for c in POI_MEASURES for p in ("sum", "n")]
    profile = profile.agg(*[F.sum(c).alias(c) for c in sums])
    narrow = bridge.select("site_id", "addr_id").where(F.col("site_id").isNotNull())
    rows = balanced_join(narrow, profile, "addr_id", right_unique=True, distinct_left=distinct_bridge, hot=hot)
    return rows.groupBy("site_id").agg(*[F.sum(c).alias(c) for c in sums])


def related_average(measure: str):
    """Average of a measure over the related points, from ``business_totals``."""
    return F.try_divide(F.col(f"sum_{measure}"), F.col(f"n_{measure}"))


def business(
    bridge: DataFrame,
    fabric: DataFrame,
    poi: DataFrame,
    brand: str,
    group: str,
    prop_type: str = "B",
    distinct_bridge: bool = False,
    hot: DataFrame | str | None = FIND,
) -> DataFrame:
    """Business features of every site that has at least one related point.

    All six come from one join and one aggregate; missing averages become 0.
    """
    total = business_totals(bridge, fabric, poi, brand, group, prop_type, distinct_bridge, hot)
    named = total.where(F.col("n_related") > 0).select(
        "site_id",
        F.col("n_related").alias("related_businesses_count"),
        related_average("employee_here").alias("avg_employee_here"),
        related_average("employee_count").alias("avg_employee_count"),
        F.col("n_all").alias("all_businesses_count"),
        F.col("n_brand").alias("brand_count"),
        related_average("sales_volume_usd").alias("avg_sales_volume_usd"),
    )
    return NullPolicy("zero").apply(named, keys=["site_id"])


def with_labels(features: DataFrame, labels: DataFrame, columns: Sequence[str] = ("review_count", "stars"), key: str = "site_id") -> DataFrame:
    """Keep labelled sites, one row each: the smallest label row where a site has several."""
    distinct = labels.select(key, *columns).where(F.col(key).isNotNull())
    return features.join(one_row_per_key(distinct, key), on=key)


def training_matrix(business_rows: DataFrame, residential_rows: DataFrame, key: str = "site_id") -> DataFrame:
    """Sites found in both tables, business columns first, one row per site."""
    return one_row_per_key(business_rows, key).join(residential_rows, on=key)


def local_sales(bridge: DataFrame, fabric: DataFrame, poi: DataFrame, column: str = "sales_volume_local", prop_type: str = "B") -> DataFrame:
    """Median local sales of the business points around each site; NULL sales drop out."""
    shops = fabric.where(F.col("prop_type") == prop_type).select("addr_id")
    sales = poi.select("addr_id", column).where(F.col(column).isNotNull()).join(shops, on="addr_id")
    rows = balanced_join(bridge.select("site_id", "addr_id"), sales, "addr_id")
    return proximity_stats(rows, "site_id", [column], ["median"])
