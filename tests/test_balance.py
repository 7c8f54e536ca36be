import random

import pytest
from pyspark.sql import functions as F

from sitescore.operators import balance
from sitescore.operators.balance import PIECES, SALT, balanced_join, hot_keys


def skewed(spark, seed=1, n=3000, m=300):
    """A third of the rows of each side share one key; some keys are NULL."""
    rng = random.Random(seed)

    def key():
        r = rng.random()
        return 7 if r < 0.33 else None if r < 0.5 else rng.randint(0, 50)

    left = spark.createDataFrame([(key(), i % 900) for i in range(n)], "k long, a long")
    right = spark.createDataFrame([(key(), i) for i in range(m)], "k long, b long")
    return left, right


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.select("k", "a", "b").collect())))


@pytest.mark.parametrize("how,few", [("inner", 16_384), ("left", 16_384), ("left", 10)])
def test_same_as_plain_join(spark, monkeypatch, how, few):
    """Split keys and broadcast hot rows (up to ``few``) give the rows of a plain join."""
    monkeypatch.setattr(balance, "MAX_BROADCAST_ROWS", few)
    left, right = skewed(spark)
    want = rows(left.join(right, on="k", how=how))
    for min_work in (1, 100, 4_000_000):
        got = balanced_join(left, right, "k", how=how, min_work=min_work)
        assert SALT not in got.columns
        assert rows(got) == want


def test_hot_right_side(spark):
    left, right = skewed(spark, n=200, m=4000)
    assert rows(balanced_join(left, right, "k", min_work=10)) == rows(left.join(right, on="k"))


@pytest.mark.parametrize("few", [16_384, 3])
def test_unique_right_and_distinct_left(spark, monkeypatch, few):
    monkeypatch.setattr(balance, "MAX_BROADCAST_ROWS", few)
    left, _ = skewed(spark)
    right = spark.createDataFrame([(i, i * 10) for i in range(40)], "k long, b long")
    want = rows(left.distinct().join(right, on="k"))
    for min_work in (5, 4_000_000):
        got = balanced_join(left, right, "k", right_unique=True, distinct_left=True, min_work=min_work)
        assert rows(got) == want


def test_hot_keys_are_bounded_and_found(spark):
    left, _ = skewed(spark)
    hot = hot_keys(left, None, ["k"], min_work=100)
    found = {r[0]: r[1] for r in hot.collect()}
    assert set(found) == {7, None} and found[7] >= 8
    many = spark.range(20_000).select(F.col("id").alias("k"))
    assert hot_keys(many, None, ["k"], min_work=1) is None
    assert hot_keys(left.groupBy("a").agg(F.max("k").alias("k")), None, ["a"], min_work=0).count() <= PIECES
    assert hot_keys(left, None, ["k"]) is None


@pytest.mark.parametrize("few", [16_384, 0])
def test_hot_key_spreads_over_tasks(spark, monkeypatch, few):
    """With a third of the rows on one key, no shuffle partition gets a third."""
    monkeypatch.setattr(balance, "MAX_BROADCAST_ROWS", few)
    left = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    right = spark.range(-1, 90_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        plain = largest(left.join(right, on="k"))
        even = largest(balanced_join(left, right, "k", right_unique=True, min_work=1000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert plain > 30_000
    assert even < 20_000
