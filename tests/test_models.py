import pytest
from pyspark.sql import functions as F

from sitescore.operators import sampling
from sitescore.ml import models
from sitescore.operators.columns import NullPolicy
from sitescore.sources import tables


@pytest.fixture(scope="module")
def matrix(spark):
    base = spark.range(600).withColumnRenamed("id", "site_id")
    x = F.pmod(F.xxhash64("site_id"), F.lit(1000)) / 1000
    z = F.pmod(F.xxhash64("site_id", F.lit(1)), F.lit(1000)) / 1000
    return base.select("site_id", x.alias("x"), z.alias("z"), F.lit(7).alias("review_count"), (1 + 3 * x + z).alias("stars"))


@pytest.fixture(scope="module")
def sets(matrix):
    from sitescore.plans.site_selection import prepare

    return prepare(matrix)


def test_features_leave_out_key_label_and_reviews(sets):
    fixed, train, test = sets
    assert fixed.columns == ("x", "z")
    assert train.columns == ["site_id", "stars", "features"] and test.count() > 100


@pytest.mark.parametrize("kind", ["dt", "rf", "gbt"])
def test_models_learn_and_repeat(sets, kind):
    _, train, test = sets
    spread = test.agg(F.stddev("stars")).first()[0]
    first, second = (models.fit(kind, train) for _ in range(2))
    assert models.metrics(first.transform(test)).first().rmse < spread / 2
    assert sorted(models.score(first, test).collect()) == sorted(models.score(second, test).collect())


def test_comparison_has_a_row_per_model(sets):
    _, train, test = sets
    fitted = {k: models.fit(k, train) for k in ("dt", "rf")}
    rows = {r.model: r for r in models.compare(fitted, test).collect()}
    assert set(rows) == {"dt", "rf"}
    assert rows["dt"].mape == pytest.approx(models.metrics(fitted["dt"].transform(test)).first().mape)


def test_layout_does_not_depend_on_the_number_of_rows(spark):
    """Rows keep their partition when more rows come in, past any multiple of 10,000."""
    place = lambda n, **more: {r.site_id: r.p for r in models.steady(spark.range(n).withColumnRenamed("id", "site_id"), **more).withColumn("p", F.spark_partition_id()).where("site_id < 50").collect()}
    assert place(50) == place(10_050) == place(20_050)
    assert models.steady(spark.range(3).withColumnRenamed("id", "site_id"), partitions=5).rdd.getNumPartitions() == 5


def test_grid(spark):
    grid = models.forest_grid(spark)
    assert grid.count() == 720 and grid.distinct().count() == 720
    assert grid.where("criterion = 'mse'").count() == 360
    assert len(models.grid_rows(a=[1, 2], b=["x", "y", "z"])) == 6


def test_grid_search_log_and_best_run(spark, sets, tmp_path):
    _, train, test = sets
    grid = models.grid_rows(n_estimators=[3, 6], criterion=["mse", "mae"], bootstrap=[True], max_samples=[0.5])
    runs = models.grid_search(train, test, grid)
    rows = runs.collect()
    assert [r.status for r in rows] == ["finished", "unsupported"] * 2  # no row is lost; Spark trees know no mae
    assert all(("mape" in r.metrics) == (r.status == "finished") and r.params["scaling"] == "none" for r in rows)
    path = str(tmp_path / "log")
    models.log_runs(runs, path)
    models.log_runs(models.grid_search(train, test, grid), path)
    log = spark.read.parquet(path)
    assert log.count() == 8 and log.select("search_id", "run_id").distinct().count() == 8
    best = models.best_run(log).first()
    assert best.metrics["mape"] == min(r.metrics["mape"] for r in rows if r.status == "finished")
    flat = runs.select("run_id", F.col("metrics")["mape"].alias("mape"))
    assert models.best_run(flat).first().mape == min(r.mape for r in flat.where("mape is not null").collect())


def test_search_shares_fits_and_keeps_rows(spark, sets, monkeypatch):
    _, train, test = sets
    fits, fit = [], models.fit
    monkeypatch.setattr(models, "fit", lambda *a, **k: fits.append(fit(*a, **k)) or fits[-1])
    grid = models.grid_rows(n_estimators=[1, 2, 5, 7], criterion=["mse", "mae"], bootstrap=[True], max_samples=[0.4])
    rows = models.grid_search(train, test, grid).orderBy("run_id").collect()
    assert len(rows) == 8 and sorted(f.getNumTrees for f in fits) == [1, 7]
    one, many = sorted(fits, key=lambda f: f.getNumTrees)
    labelled = [(r.stars, r.features) for r in test.collect()]
    for r in rows:
        k = int(r.params["n_estimators"])
        assert r.status == ("finished" if r.params["criterion"] == "mse" else "unsupported")
        if r.status == "finished":
            trees = one.trees if k == 1 else many.trees[:k]
            errors = [abs(y - sum(t.predict(v) for t in trees) / k) for y, v in labelled]
            assert r.metrics["mae"] == pytest.approx(sum(errors) / len(errors))
    whole = models.metrics(many.transform(test)).first()
    assert all(rows[-2].metrics[m] == pytest.approx(whole[m]) for m in ("rmse", "mape", "mae"))


def test_registered_search_covers_the_grid(spark):
    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.001"
    rows = entry.queries()["grid_search"](spark, folder).collect()
    assert {(r.n_estimators, r.criterion, r.max_samples) for r in rows} == {tuple(str(p[k]) for k in ("n_estimators", "criterion", "max_samples")) for p in models.grid_rows(**models.GRID)}
    assert len(rows) == 720 and sum(r.status == "finished" for r in rows) == 360
    assert all((r.mape is not None) == (r.status == "finished") for r in rows)
    best = entry.queries()["best_grid_run"](spark, folder).first()
    assert best.mape == min(r.mape for r in rows if r.mape is not None)


def test_final_model(sets):
    _, train, test = sets
    model, held_out = models.train_final(train, test)
    assert model.getNumTrees == 51 and model.getOrDefault("maxDepth") == 3
    assert held_out.first().rmse > 0


def test_scaling_uses_training_rows(spark, sets):
    _, train, test = sets
    scaled_train, scaled_test = models.scale(train, test)
    from pyspark.ml.functions import vector_to_array

    means = scaled_train.select(vector_to_array("features").alias("v")).agg(F.avg(F.col("v")[0]), F.stddev(F.col("v")[0])).first()
    assert means[0] == pytest.approx(0, abs=1e-9) and means[1] == pytest.approx(1)
    assert scaled_test.count() == test.count()
    rows = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, 9.0)], "site_id long, v double")
    got = [r.v for r in models.scale_columns(rows, rows.where("site_id < 3"), ["v"]).orderBy("site_id").collect()]
    assert got == pytest.approx([-1.0, 1.0, 7.0])


def test_scoring_reuses_the_fitted_rule(spark, sets, matrix):
    train = matrix.withColumn("late", F.when(F.col("site_id") > 5, F.lit(1.0)))
    fixed = models.FeatureList.fit(train, NullPolicy("drop_columns"))
    assert fixed.columns == ("x", "z")
    candidates = matrix.select("site_id", "x", "z").withColumn("late", F.lit(2.0))
    assert fixed.assemble(candidates).columns == ["site_id", "features"]
    zero = models.FeatureList.fit(train)
    with_nulls = spark.createDataFrame([(1, None, 0.5, None)], "site_id long, x double, z double, late double")
    assert zero.assemble(with_nulls).first().features.toArray().tolist() == [0.0, 0.5, 0.0]


def test_sample_rows(spark, matrix):
    grid = models.with_sample_rows(models.param_grid(spark, max_samples=[0.25, 1.0]), matrix)
    assert {tuple(r) for r in grid.collect()} == {(0.25, 150), (1.0, 600)}


def test_batches_resume(spark, tmp_path):
    calls = []
    df = spark.createDataFrame([(i, i % 3) for i in range(9)], "site_id long, batch_id long")

    def doubled(batch):
        calls.append(1)
        return batch.withColumn("twice", F.col("site_id") * 2)

    steps = {"first": doubled, "second": lambda batch: batch.where("twice > 2")}
    out = tables.run_in_batches(df, steps, str(tmp_path))
    assert len(calls) == 3
    tables.run_in_batches(df, steps, str(tmp_path))
    assert len(calls) == 3
    (tmp_path / "first" / "batch_id=1" / "_SUCCESS").unlink()
    tables.run_in_batches(df, steps, str(tmp_path))
    assert len(calls) == 4
    assert spark.read.parquet(out["first"]).count() == 9
    assert spark.read.parquet(out["second"]).count() == 7


def test_appending_allows_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not tables.append_evolving(spark.range(0), path)
    assert tables.append_evolving(spark.range(3), path)
    assert tables.append_evolving(spark.range(2).withColumn("extra", F.lit("x")), path)
    assert sorted(map(str, tables.read_evolving(spark, path).collect())) == sorted(
        [f"Row(id={i}, extra=None)" for i in range(3)] + [f"Row(id={i}, extra='x')" for i in range(2)]
    )


def test_limit_batches(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(20)], "site_id long, batch_id long")
    assert {r.batch_id for r in tables.limit_batches(df, 2).collect()} == {0, 1}
    assert tables.limit_batches(df, 2).count() == 10


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("addr_id"), (F.col("id") % 7).alias("site_id"))
    left = tables.write_table(rows, "bucketed_bridge", str(tmp_path / "l"), bucket_by=(4, "addr_id"))
    right = tables.write_table(rows.select("addr_id"), "bucketed_fabric", str(tmp_path / "r"), bucket_by=(4, "addr_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, "addr_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_bridge")
        spark.sql("DROP TABLE bucketed_fabric")


def test_split_by_text_keys(spark):
    rows = spark.createDataFrame([(f"site-{n}", n) for n in range(500)], "site_id string, n long")
    train, test = sampling.split(rows)
    assert train.count() + test.count() == 500 and 100 < test.count() < 200
    numbers = spark.createDataFrame([(n, str(n)) for n in range(300)], "site_id long, text string")
    assert {r.site_id for r in sampling.split(numbers)[1].collect()} == {r.site_id for r in sampling.split(numbers, key="text")[1].collect()}
