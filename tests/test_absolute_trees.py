"""Absolute-error trees against plain Python, and the whole search."""

from __future__ import annotations

import random
import statistics

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from sitescore.ml import absolute_trees, models
from sitescore.plans import tuning


def rows_of(n, seed, labels=9):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        v = [float(rng.randrange(6)), rng.random(), float(rng.randrange(3)), rng.gauss(0, 1)]
        y = 1 + 0.5 * min(labels - 1, int(v[0] + 3 * (v[1] > 0.5) + rng.randrange(2)))
        out.append((i, y, v))
    return out


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, y, Vectors.dense(v)) for i, y, v in rows], ["site_id", "stars", "features"]).repartition(parts)


def plain_tree(rows, scale, depth, node=1):
    """{node: (value, feature, cut)} by trying every split."""
    y = [r[1] for r in rows]
    error = lambda ys: sum(abs(v - statistics.median(ys)) for v in ys)
    out = {node: (statistics.median(y), -1, 0)}
    if depth == 0:
        return out
    best = (1e-9, None)
    for f, marks in enumerate(scale.thresholds):
        for cut, mark in enumerate(marks):
            left, right = [r[1] for r in rows if r[2][f] <= mark], [r[1] for r in rows if r[2][f] > mark]
            if left and right:
                saved = round(error(y) - error(left) - error(right), 9)
                if saved > best[0]:
                    best = (saved, f, cut, mark)
    if best[1] is not None:
        _, f, cut, mark = best
        out[node] = (out[node][0], f, cut)
        out |= plain_tree([r for r in rows if r[2][f] <= mark], scale, depth - 1, 2 * node)
        out |= plain_tree([r for r in rows if r[2][f] > mark], scale, depth - 1, 2 * node + 1)
    return out


@pytest.mark.parametrize("parts", [1, 4])
def test_one_tree_is_the_tree_of_all_splits(spark, monkeypatch, parts):
    rows = rows_of(300, 1)
    train = frame(spark, rows, parts)
    # every row once: without replacement, with a chance of 1
    grown = absolute_trees.grow(train, [1.0], [False], depth=4, share=1.0)
    want = plain_tree(rows, grown.scale, 4)
    assert len(want) > 15
    for node, (value, feature, cut) in want.items():
        assert grown.value[0, node] == value and grown.feature[0, node] == feature
        assert feature < 0 or grown.cut[0, node] == cut
    bins = grown.scale.bins(np.array([r[2] for r in rows]))
    scored = {r.site_id: r.prediction for r in absolute_trees.score(grown, train).collect()}
    assert [scored[r[0]] for r in rows] == grown.predicted(bins)[:, 0].tolist()


def test_drawn_rows(spark):
    """A drawn tree is the tree of its rows, each as often as it was drawn; the draw follows the rate."""
    rows = rows_of(200, 2)
    train = frame(spark, rows)
    grown = absolute_trees.grow(train, [0.5, 0.5, 0.9], [True, True, True], depth=3, share=1.0)
    keys = {r.site_id: r.key for r in train.selectExpr("site_id", "xxhash64(site_id) AS key").collect()}
    hashes = np.array([keys[r[0]] for r in rows]).view(np.uint64)
    for t, rate in enumerate(grown.rates):
        drawn = absolute_trees.draws(hashes, t, rate, True, grown.seed)
        want = plain_tree([r for r, k in zip(rows, drawn) for _ in range(k)], grown.scale, 3)
        assert all(grown.value[t, n] == v and grown.feature[t, n] == f for n, (v, f, _) in want.items())
    assert (grown.feature[0] != grown.feature[1]).any() or (grown.cut[0] != grown.cut[1]).any()
    many = absolute_trees.draws(absolute_trees.spread_bits(np.arange(100000, dtype=np.uint64)), 3, 0.7, True, 1)
    assert abs(many.mean() - 0.7) < 0.02 and abs(many.var() - 0.7) < 0.03


def test_trees_do_not_depend_on_partitions(spark):
    rows = rows_of(150, 3)
    grown = [absolute_trees.grow(frame(spark, r, p), [0.5] * 4, [True] * 4, depth=3) for r, p in ((rows, 1), (rows[::-1], 7))]
    grown.append(absolute_trees.grow(frame(spark, rows, 2), [0.5] * 4, [True] * 4, depth=3, most_bytes=1))
    for name in ("feature", "cut", "value"):
        assert all(np.array_equal(getattr(grown[0], name), getattr(g, name), equal_nan=True) for g in grown[1:])


def test_many_labels_and_idle_trees(spark):
    """More labels than are told apart, a tree without rows, one row, and equal rows."""
    rng = random.Random(4)
    rows = [(i, rng.random(), [rng.random(), 1.0]) for i in range(500)]
    train = frame(spark, rows)
    grown = absolute_trees.grow(train, [1.0, 0.0], [False, True], depth=3, share=1.0)
    assert len(grown.scale.labels) <= 64
    assert grown.value[1, 1] == pytest.approx(statistics.median(r[1] for r in rows)) and (grown.feature[1] == -1).all()
    one = absolute_trees.grow(frame(spark, rows[:1], 1), [1.0], [False])
    assert one.value[0, 1] == pytest.approx(rows[0][1]) and (one.feature == -1).all()
    same = absolute_trees.grow(frame(spark, [(i, 2.0, [1.0, 3.0]) for i in range(5)], 2), [1.0], [False])
    assert same.value[0, 1] == 2.0 and (same.feature == -1).all()


def test_search_measures_both_criteria(spark):
    train, test = frame(spark, rows_of(200, 5)), frame(spark, [*rows_of(80, 6), (900, 0.0, [1.0, 0.5, 1.0, 0.0])])
    grid = models.grid_rows(n_estimators=[1, 2, 4], criterion=["mse", "mae"], bootstrap=[True], max_samples=[0.4, 0.8])
    log = tuning.search(train, test, grid).orderBy("run_id").collect()
    assert [r.run_id for r in log] == list(range(len(grid))) and all(r.status == "finished" for r in log)
    labelled = [(r.stars, r.features.toArray()) for r in test.collect()]
    grown = absolute_trees.grow(train, [0.4] * 4 + [0.8] * 4, [True] * 8)
    each = grown.predicted(grown.scale.bins(np.array([v for _, v in labelled])))
    y = np.array([v for v, _ in labelled])
    for p, r in zip(grid, log):
        if p["criterion"] == "mae" and p["n_estimators"] > 1:
            begin = 0 if p["max_samples"] == 0.4 else 4
            error = np.abs(each[:, begin : begin + p["n_estimators"]].mean(axis=1) - y)
            assert r.metrics["mae"] == pytest.approx(error.mean()) and r.metrics["rmse"] == pytest.approx((error**2).mean() ** 0.5)
            assert r.metrics["mape"] == pytest.approx(100 * (error[y != 0] / y[y != 0]).mean())
    spread = statistics.mean(abs(v - statistics.median(y.tolist())) for v in y.tolist())
    assert max(r.metrics["mae"] for p, r in zip(grid, log) if p["n_estimators"] == 4) < spread


def test_tuning_flow(spark):
    """Columns with a NULL go, features are standardised, and the log says so."""
    rows = [(i, 3, y, *v, None if i == 7 else 1.0) for i, y, v in rows_of(250, 7)]
    matrix = spark.createDataFrame(rows, "site_id long, review_count int, stars double, a double, b double, c double, d double, holes double")
    grid = models.grid_rows(n_estimators=[3], criterion=["mse", "mae"], bootstrap=[True], max_samples=[0.5])
    log = tuning.tune(matrix, grid).collect()
    assert len(log) == 2 and {r.params["scaling"] for r in log} == {"standard"} and all(r.metrics["mape"] > 0 for r in log)
    assert models.best_run(tuning.tune(matrix, grid)).first().metrics["mape"] == min(r.metrics["mape"] for r in log)


def test_registered_search_measures_the_whole_grid(spark):
    import __spark_entry__ as entry

    rows = entry.queries()["tuned_search"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 720 and {r.status for r in rows} == {"finished"} and all(r.mape is not None and r.mae is not None for r in rows)
    assert len({(r.n_estimators, r.criterion, r.max_samples) for r in rows}) == 720
