import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from sitescore.functions import measures
from sitescore.operators import rank, sampling


def test_zero_label_drops_out_of_mape(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0), (4.0, 3.0)], "y double, p double")
    row = df.agg(measures.mape(F.col("y"), F.col("p")), measures.mae(F.col("y"), F.col("p")), measures.rmse(F.col("y"), F.col("p"))).first()
    assert tuple(row) == pytest.approx((37.5, 1.0, 1.0))


def test_measures_equal_the_evaluator(spark):
    df = spark.range(1, 200).select((F.col("id") * 0.7).alias("label"), (F.col("id") * 0.6 + F.sin("id")).alias("prediction"))
    y, p = F.col("label"), F.col("prediction")
    row = df.agg(measures.rmse(y, p).alias("rmse"), measures.mae(y, p).alias("mae")).first()
    for name in ("rmse", "mae"):
        assert row[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(df))


def test_flat_metric_scales_to_null(spark):
    df = spark.createDataFrame([(1, 5.0, 1), (2, 5.0, 3), (3, None, 2)], "site_id long, price double, size int")
    got = {r.site_id: (r.adj_price, r.adj_size) for r in rank.min_max(df, ["price", "size"]).collect()}
    assert got == {1: (None, 0.0), 2: (None, 1.0), 3: (None, 0.5)}


def test_ties_go_to_the_smaller_id(spark):
    df = spark.createDataFrame([(5, 3.0), (4, 3.0), (3, 3.0), (2, 9.0), (1, None)], "site_id long, score double")
    assert [r.site_id for r in rank.top_k(df, "score").collect()] == [2, 3, 4]
    assert [r.site_id for r in rank.rank(df, "score").collect()] == [2, 3, 4, 5, 1]
    assert [r.site_id for r in rank.rank(df, "score", ascending=True).collect()] == [3, 4, 5, 2, 1]
    plan = rank.top_k(df, "score")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_combined_score(spark):
    rows = [(1, 4.0, 10.0, 100.0, 50), (2, 5.0, 30.0, 200.0, 150), (3, 3.0, None, 150.0, 100)]
    df = spark.createDataFrame(rows, "site_id long, stars_score double, median_sales_volume_local double, price double, size_sqft int")
    got = [(r.site_id, r.score) for r in rank.combined_score(df).collect()]
    # stars 2, sales 1, price -2, size 0.5
    assert got == [(2, pytest.approx(2 + 1 - 2 + 0.5)), (1, pytest.approx(1.0)), (3, None)]


def test_winners_show_attributes(spark):
    scores = spark.createDataFrame([(i, float(i)) for i in range(10)], "site_id long, score double")
    names = spark.createDataFrame([(i, f"n{i}") for i in range(10)], "site_id long, name string")
    assert [tuple(r) for r in rank.winners(scores, names, "score", ["name"]).collect()] == [(9, 9.0, "n9"), (8, 8.0, "n8"), (7, 7.0, "n7")]


def test_samples_depend_on_the_key_only(spark):
    df = spark.range(20_000).withColumnRenamed("id", "site_id")
    one = {r[0] for r in sampling.sample_sites(df.repartition(3), 0.05).collect()}
    two = {r[0] for r in sampling.sample_sites(df.repartition(8), 0.05).collect()}
    assert one == two and 800 < len(one) < 1200
    train, test = sampling.split(df)
    assert train.count() + test.count() == 20_000 and 5500 < test.count() < 6500
    assert train.join(test, "site_id").isEmpty()
    other = {r[0] for r in sampling.sample_sites(df, 0.05, seed=7).collect()}
    assert other != one
