"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitescore.llm.kit import kept, whole_text

WORDS = r"[^ \t-\r]+"


def _ranked(sources: DataFrame) -> DataFrame:
    """Number the sources by code point, null last, without gathering them in one task."""
    rows = kept(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("__at", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("__at", 33)
    counts = {r[0]: r[1] for r in rows.groupBy(part).count().collect()}  # one row per partition
    before, seen = {}, 0
    for key in sorted(counts):
        before[key] = seen
        seen += counts[key]
    start = F.lit(0).cast("long")
    for key, value in before.items():
        start = F.when(part == key, F.lit(value)).otherwise(start)
    return rows.withColumn("rank", start + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__at")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, epochs: float = 2.0) -> DataFrame:
    """(source, source_size, rank, target) from one (source, source_size) row per source.

    All sources share ``share`` times the sum of sizes by weight. A source whose
    part exceeds ``epochs`` times its size is clamped there, and the others
    share what is left, until none is above. The sources stay distributed; each
    round returns two sums.
    """
    rows = _ranked(sizes)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = rows.withColumns({"weight": weight, "cap": F.col("source_size") * float(epochs)})
    goal = float(share) * float(rows.agg(F.sum("source_size")).first()[0] or 0)
    level, clamped = 0.0, -1
    while True:
        full = F.col("cap") <= F.col("weight") * level
        caps, free, count = rows.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))).first()
        if count == clamped or not free:
            break
        clamped, level = count, max(level, (goal - (caps or 0.0)) / free)
    return rows.select("source", "source_size", "rank", F.least("cap", F.col("weight") * level).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, epochs: float = 2.0, seed: int = 17, buckets: int = 1024) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    A document's size is its number of words (null text: 0). Each source gives
    its target in whole repetitions of all its documents plus a fraction: the
    documents are put in an order drawn by ``seed`` and taken once more until
    the rest of the target is used up, the last one in part. So a source's taken
    words are its rounded target, and no document exceeds ``epochs`` times its
    size. Running sums go over (source, bucket of the order) and then inside one
    bucket, so no task holds a whole source. Null sources are one source, last;
    null or repeated ids are rows like others; a source without words takes 0.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", whole_text()).alias("draw"),
    )
    rows = kept(rows, "sizes")
    goals = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, epochs)
    goals = goals.withColumn("words", F.round("target").cast("long"))
    goals = goals.withColumn("whole", F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(0))
    goals = goals.withColumn("rest", F.col("words") - F.col("whole") * F.col("source_size"))
    goals = kept(goals.withColumnRenamed("source", "__source"), "targets")
    rows = rows.join(goals, rows["source"].eqNullSafe(goals["__source"])).drop("__source")
    rows = rows.withColumn("bucket", F.pmod("draw", F.lit(buckets)).cast("int"))
    sums = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("held"))
    sums = sums.withColumn("before", F.sum("held").over(Window.partitionBy("rank").orderBy("bucket")) - F.col("held")).drop("held")
    inside = Window.partitionBy("rank", "bucket").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.join(kept(sums, "sums"), ["rank", "bucket"])
    start = F.col("before") + F.sum("size").over(inside) - F.col("size")
    extra = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - start))
    taken = F.col("whole") * F.col("size") + extra
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))
