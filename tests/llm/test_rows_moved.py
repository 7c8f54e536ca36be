"""Dropping copies moves only the whole rows that may go, and drops the right ones."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from sitescore.llm import kit
from sitescore.llm.exact_dedup import drop_copies
from sitescore.llm.jaccard_join import drop_near_copies
from sitescore.llm.kit import ship, split_by_keys
from tests.llm import reference as ref


@pytest.fixture
def no_broadcast(spark):
    """As on large tables: no join is broadcast unless it says so."""
    former = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", former)


def moved(node, column: str) -> int:
    """Rows with ``column`` that the exchanges of an executed plan wrote."""
    if node.nodeName() == "AdaptiveSparkPlan":
        return moved(node.executedPlan(), column)
    if "QueryStage" in node.nodeName():
        return moved(node.plan(), column)
    out, children = node.output(), node.children()
    held = any(out.apply(i).name() == column for i in range(out.size()))
    own = node.metrics().apply("shuffleRecordsWritten").value() if node.nodeName() == "Exchange" and held else 0
    return own + sum(moved(children.apply(i), column) for i in range(children.size()))


def corpus(spark, repeats: bool):
    """2000 texts of 30 words, each 100th with a copy of larger id; with ``repeats``, whole rows twice as well."""
    texts = [(d, " ".join(f"w{d}x{k}" for k in range(30)), "en", "s", 0, 0, "", "", 0.0) for d in range(2000)]
    copies = [(2000 + r[0], *r[1:]) for r in texts[::100]]
    rows = texts + copies + (texts[50::200] + copies[::4] if repeats else [])
    return spark.createDataFrame(rows, ref.SCHEMA)


@pytest.mark.parametrize("repeats", [False, True])
@pytest.mark.parametrize("drop", [drop_copies, drop_near_copies])
def test_rows_that_stay_are_not_moved(spark, no_broadcast, drop, repeats):
    ship(spark)
    left = drop(corpus(spark, repeats))
    ids = sorted(r.doc_id for r in left.collect())
    stays = set(range(0, 2000, 100))
    assert ids == (sorted(set(range(2000)) - stays | {d + 2000 for d in stays}) if drop is drop_copies else list(range(2000)))
    assert moved(left._jdf.queryExecution().executedPlan(), "text") < 800


@pytest.mark.parametrize("most_pages", [4096, 1])
def test_split_by_keys(spark, most_pages):
    """Each row is in one part, each row with a key in the first, few others with it."""
    rows = spark.range(40000).select(F.when(F.col("id") > 0, F.col("id")).alias("key"), F.lit("x").alias("text")).repartition(3)
    keys = rows.where("key is null or key % 10 = 3").select("key")
    some, others = (p.collect() for p in split_by_keys(rows, F.col("key"), keys, most_pages=most_pages))
    assert some[0].__fields__ == ["key", "text"] and len(some) + len(others) == 40000
    assert not any(r.key is None or r.key % 10 == 3 for r in others) and len({r.key for r in some} | {r.key for r in others}) == 40000
    assert len(some) < (4001 + 4000 if most_pages > 1 else 4001 + 7000)


def test_split_by_no_keys(spark):
    rows = spark.range(5).toDF("key")
    some, others = split_by_keys(rows, F.col("key"), rows.limit(0))
    assert some.count() == 0 and others.count() == 5


def test_written_tables_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    """Shuffle files of a table go when it is written; the session's setting is as before."""
    folders = []
    monkeypatch.setattr(kit, "scratch_path", lambda session, name: folders.append(name) or str(tmp_path / f"{name}{len(folders)}"))
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> int:
        return local.getAllFiles().mkString("\n").count(".data")

    former, before = spark.conf.get(kit.CLEANUP), shuffled()
    made = spark.range(5000).groupBy((F.col("id") % 100).alias("k")).agg(F.count("*").alias("n"))
    table = kit.Scratch(spark).keep(made, "t")
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before and spark.conf.get(kit.CLEANUP) == former
    assert table.count() == 100 and made.count() == 100
