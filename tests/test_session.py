"""Written tables: what Spark takes them for."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sitescore.functions import geometry
from sitescore.operators import geofence
from sitescore.session import cut_lineage


@pytest.fixture
def threshold(spark):
    """Tables of up to 64 KB may be broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    former = spark.conf.get(name)
    spark.conf.set(name, "64k")
    yield
    spark.conf.set(name, former)


def test_many_rows_of_few_are_not_taken_for_a_small_table(spark, threshold):
    few = spark.range(10).withColumn("key", F.col("id") % 3)
    many = cut_lineage(few.select("key", F.explode(F.sequence(F.lit(0), F.lit(9999))).alias("x"), F.rand(3).alias("y")))
    other = spark.range(100_000).select((F.col("id") % 5).alias("key"), F.rand(4).alias("z"))
    joined = many.join(other, on="key", how="left_semi")
    assert "Broadcast" not in many.join(other, on="key")._jdf.queryExecution().sparkPlan().toString()
    assert many.count() == 100_000 and joined.count() == 100_000
    # references from before and the layout of the rows stay
    assert many.select(many["x"]).rdd.getNumPartitions() == many.rdd.getNumPartitions()
    small = cut_lineage(few)
    assert "Broadcast" in small.join(other, on="key")._jdf.queryExecution().sparkPlan().toString()


def test_cells_of_polygons_are_not_broadcast(spark, threshold, monkeypatch):
    """The grid cells of few polygons are many wide rows."""
    plans, join = [], geofence.balanced_join

    def watched(left, right, *a, **b):
        joined = join(left, right, *a, **b)
        plans.append(joined._jdf.queryExecution().sparkPlan().toString())
        return joined

    monkeypatch.setattr(geofence, "balanced_join", watched)
    sites = spark.range(60).select(F.col("id").alias("site_id"), (F.col("id") / 10).alias("x"), (F.col("id") / 10).alias("y"))
    addresses = spark.range(50_000).select(F.col("id").alias("addr_id"), (F.col("id") % 100 / 15).alias("lon"), (F.col("id") % 77 / 12).alias("lat"))
    shaped = sites.select("site_id", geometry.octagon("x", "y", "0.4D").alias("polygon"))
    hits = geofence.geofence(shaped, addresses)
    assert len(plans) == 1 and "Broadcast" not in plans[0]
    assert hits.count() > 1000
