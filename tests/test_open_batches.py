"""All open batches in one job for each step, and going on after a stop."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from sitescore.sources import tables


def rows(spark, batches):
    data = [(i, batches[i % len(batches)]) for i in range(20)]
    return spark.createDataFrame(data, "site_id long, batch_id long")


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_one_call_for_each_step_and_resume(spark, tmp_path):
    calls = []
    steps = {
        "first": lambda df: (calls.append("first"), df.withColumn("x", F.col("site_id") * 2))[1],
        # batch 2 has no result here
        "second": lambda df: (calls.append("second"), df.where("batch_id is null or batch_id <> 2"))[1],
    }
    folder = str(tmp_path / "out")
    few, every = rows(spark, [0, 1, 2, 3, None]), rows(spark, [0, 1, 2, 3, None, 4, 5, 6, 7, 8])
    out = tables.run_open_batches(few, steps, folder)
    assert calls == ["first", "second"]
    got = spark.read.schema("site_id long, x long, batch_id long").parquet(out["first"])
    assert sorted((r.site_id, r.batch_id, r.x) for r in got.where("batch_id is not null").collect()) == sorted((i, i % 5, 2 * i) for i in range(20) if i % 5 < 4)
    assert got.where("batch_id is null").count() == 4
    assert spark.read.schema("site_id long, x long, batch_id long").parquet(out["second"]).count() == 16

    before = files(out["first"])
    tables.run_open_batches(few, steps, folder)
    assert files(out["first"]) == before  # nothing is left to do
    calls.clear()
    tables.run_open_batches(every.where("batch_id >= 4").unionAll(few), steps, folder)
    assert calls == ["first", "second"]
    assert before.items() <= files(out["first"]).items()  # finished batches stay as they are
    assert spark.read.schema("batch_id long").parquet(out["first"]).select("batch_id").distinct().count() == 10


def test_a_stopped_step_is_done_again(spark, tmp_path):
    folder, df = str(tmp_path / "out"), rows(spark, [0, 1, 2])
    stop = F.when(F.col("site_id") == 7, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("site_id"))
    with pytest.raises(Exception, match="stop"):
        tables.run_open_batches(df, {"first": lambda d: d, "second": lambda d: d.withColumn("y", stop)}, folder)
    again = []
    out = tables.run_open_batches(df, {"first": lambda d: d.where(F.lit(False)), "second": lambda d: again.append(1) or d.withColumn("y", F.col("site_id"))}, folder)
    assert spark.read.parquet(out["first"]).count() == 20  # finished in the first run
    assert sorted(r.y for r in spark.read.parquet(out["second"]).collect()) == list(range(20)) and again == [1]


def test_empty_input(spark, tmp_path):
    out = tables.run_open_batches(rows(spark, [0]).limit(0), {"first": lambda d: d, "second": lambda d: d}, str(tmp_path / "out"))
    assert spark.read.schema("site_id long, batch_id long").parquet(out["second"]).count() == 0
