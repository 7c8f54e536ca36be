"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescore.llm.kit import Scratch, kept


def _stars(batches: Iterator[pa.RecordBatch], most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """(u, v) links that join what the links of a task join: each node u with the smallest node v it reaches there.

    A task holds about ``most`` nodes at a time and starts anew beyond that.
    """
    least: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := least.setdefault(top, top)) != top:
            top = up
        while least[x] != top:
            least[x], x = top, least[x]
        return top

    def found() -> pa.RecordBatch:
        links = [(u, root(u)) for u in list(least)]
        links = [(u, v) for u, v in links if u != v]
        return pa.record_batch({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})

    for batch in batches:
        for u, v in zip(batch["u"].to_pylist(), batch["v"].to_pylist()):
            x, y = root(u), root(v)
            least[max(x, y)] = min(x, y)
        if len(least) > most:
            yield found()
            least.clear()
    yield found()


def components(links: DataFrame, task_links: int = 1 << 16) -> DataFrame:
    """(node, component) for every node of the (a, b) links; component is the smallest node reached.

    Tasks of about ``task_links`` links first join what their own links join,
    which leaves stars. Where those still touch, rounds of large and small stars
    follow: each node hands its neighbours over to the smallest of them, until
    every node points at the smallest of its component. Only links move; the
    number of rounds grows with the logarithm of the size.
    """

    def star(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both if larger else both.where("v <= u")
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        near = near.where("v > u") if larger else near
        moved = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not larger:
            moved = moved.unionAll(least.select("u", F.col("m").alias("v")))
        return moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    scratch = Scratch(links.sparkSession)
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    while True:
        tasks = max(1, math.ceil(edges.count() / task_links))
        edges = scratch.keep(edges.coalesce(tasks).mapInArrow(_stars, "u long, v long"), "edges")
        # done if no node points at two others, or points and is pointed at
        ends = edges.select(F.col("u").alias("node"), "v").unionAll(edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("v")))
        ends = ends.groupBy("node").agg(F.min("v").alias("least"), F.max("v").alias("most"), F.count_if(F.col("v").isNull()).alias("below"))
        if ends.where("least < most or (least is not null and below > 0)").isEmpty():
            break
        edges = scratch.keep(star(edges, True), "edges")
        edges = scratch.keep(star(edges, False), "edges")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")))
    out = kept(roots.distinct(), "components")
    scratch.drop("edges")
    return out
