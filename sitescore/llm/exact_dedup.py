"""Exact dedup by deterministic block naming, in DataFrame operations only.

Each text is cut into blocks of a fixed size. Equal blocks get one integer name
by sorting them; then neighbouring names are paired and the pairs named in turn,
until each document has one name left. Names come from sorting contents and not
from hashing them, so two documents share a name only if their texts are equal;
a hash merely says in which shard a block is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitescore.llm.kit import Scratch, kept, split_by_keys, whole_text

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; pure ASCII texts take the quick way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _hot(rows: DataFrame, keys: list[str], most: int, sample: int) -> DataFrame | None:
    """Up to ``most`` keys that hold more than their share of the rows, by a sample of documents.

    This only decides which names are joined in by broadcast; it changes no result.
    """
    part = rows.where(F.pmod(F.xxhash64("doc_id", "tag"), F.lit(sample)) == 0)
    part = part.groupBy(F.xxhash64(*keys).alias("__h")).agg(F.count("*").alias("__n"), *[F.first(k).alias(k) for k in keys])
    part = kept(part.where("__n > 8"), "hot")
    total = part.agg(F.sum("__n")).first()[0]
    if not total:
        return None
    whole = rows.count()
    part = part.where(F.col("__n") * sample > max(64, whole // most)).orderBy(F.desc("__n"), *keys).limit(most)
    part = part.withColumn("__hot", F.row_number().over(Window.orderBy(F.desc("__n"), *keys)).cast("long"))
    return kept(part.select(*keys, "__hot"), "hot")


def named(rows: DataFrame, keys: list[str], shard_bits: int = 24, most_hot: int = 1024, sample: int = 16) -> DataFrame:
    """Replace the columns ``keys`` by one column ``name`` that is equal just for equal keys.

    Rows go to shards by a hash of the keys; inside a shard they are sorted and
    numbered. Keys with a large share of the rows would swell a shard: they are
    numbered on their own and joined by broadcast (at most ``most_hot`` of one
    block each), and their rows are spread over all shards.
    """
    shard = F.xxhash64(*keys).bitwiseAND(F.lit((1 << shard_bits) - 1))
    hot = _hot(rows, keys, most_hot, sample)
    if hot is None:
        rows = rows.withColumn("__hot", F.lit(None).cast("long"))
    else:
        same = [rows[k].eqNullSafe(hot[k]) for k in keys]
        on = same[0]
        for more in same[1:]:
            on = on & more
        rows = rows.join(F.broadcast(hot), on, "left").select(*[rows[c] for c in rows.columns], hot["__hot"])
        spread = F.xxhash64("doc_id", "tag", "pos").bitwiseAND(F.lit((1 << shard_bits) - 1))
        shard = F.when(F.col("__hot").isNull(), shard).otherwise(-1 - spread)
        rows = rows.withColumn("__shard", shard)
        rows = rows.withColumns({k: F.when(F.col("__hot").isNull(), F.col(k)) for k in keys})
    if "__shard" not in rows.columns:
        rows = rows.withColumn("__shard", shard)
    rank = F.dense_rank().over(Window.partitionBy("__shard").orderBy(*keys))
    name = F.coalesce(-F.col("__hot"), F.col("__shard") * F.lit(1 << 32) + rank)
    return rows.withColumn("name", name).drop(*keys, "__hot", "__shard")


def identities(docs: DataFrame, block: int = 4096) -> DataFrame:
    """(doc_id, text_sha256, level, name, copies): equal (level, name) just for equal normalised texts.

    One row for each document or, where rows repeat the same id and text, for
    all of them with their number in ``copies``. A null text is an empty one, a
    null id is an id of its own.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ascii_lower(whole_text()).alias("t"))
    cut = F.when(F.char_length("t") <= block, F.array("t")).otherwise(F.regexp_extract_all("t", F.lit(f"(?s).{{1,{block}}}"), F.lit(0)))
    rows = rows.select("doc_id", F.xxhash64("t").alias("tag"), F.sha2("t", 256).alias("sha"), cut.alias("cut"))
    rows = rows.select("doc_id", "tag", "sha", F.size("cut").alias("blocks"), F.posexplode("cut").alias("pos", "block"))
    rows = rows.select("doc_id", "tag", "blocks", "pos", F.when(F.col("pos") == 0, F.col("sha")).alias("sha"), F.lit(1).cast("long").alias("copies"), "block")
    # the shuffled blocks hold all texts and go once they are named
    level, rows, done = 0, Scratch(docs.sparkSession).keep(named(rows, ["block"]), "names"), []
    while True:
        done.append(rows.where("blocks = 1").select("doc_id", F.col("sha").alias("text_sha256"), F.lit(level).alias("level"), "name", "copies"))
        rows = rows.where("blocks > 1")
        if rows.isEmpty():
            break
        left = F.col("pos") % 2 == 0
        rows = rows.groupBy("doc_id", "tag", "blocks", F.expr("pos div 2").alias("half")).agg(
            F.max("sha").alias("sha"),
            F.sum(F.when(left, F.col("copies")).otherwise(0)).alias("copies"),
            F.max(F.when(left, F.col("name"))).alias("a"),
            F.max(F.when(~left, F.col("name"))).alias("b"),
        )
        rows = rows.select("doc_id", "tag", F.expr("cast((blocks + 1) div 2 as int)").alias("blocks"), F.col("half").cast("int").alias("pos"), "sha", "copies", "a", "b")
        rows = kept(named(kept(rows, "pairs"), ["a", "b"]), "names")
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out.groupBy("doc_id", "text_sha256", "level", "name").agg(F.sum("copies").alias("copies"))


def exact_dedup(docs: DataFrame, block: int = 4096) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are so after lower-casing A-Z; null counts as empty.
    Of equal texts the row with the largest doc_id stays; null is smaller than
    any id, and of rows that repeat the same id and text one stays.
    """
    rows = kept(identities(docs, block), "identities")
    groups = rows.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    groups = kept(groups, "groups")
    rows = rows.join(groups, ["level", "name"]).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return rows.select("doc_id", "keep_id", "group_size", stays.alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, block: int = 4096) -> DataFrame:
    """``docs`` without the rows that :func:`exact_dedup` drops, all columns kept."""
    gone = exact_dedup(docs, block).where("not kept")
    gone = kept(gone.groupBy(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).agg(F.first("keep_id").alias("__keep")), "gone")
    sha = F.sha2(ascii_lower(whole_text()), 256)
    # rows whose own id is also the one that stays are repeats: one of them is left
    whole = gone.where("not (__id <=> __keep)")
    again = gone.where("__id <=> __keep")
    # a dropped row has an id of these; whole texts of other ids are not shuffled
    rows, others = split_by_keys(docs, F.col("doc_id").cast("long"), gone.select("__id"))
    rows = rows.withColumn("__row_sha", sha)
    rows = rows.join(whole, rows["doc_id"].cast("long").eqNullSafe(whole["__id"]) & (rows["__row_sha"] == whole["__sha"]), "left_anti")
    if not again.isEmpty():
        match = rows["doc_id"].cast("long").eqNullSafe(again["__id"]) & (rows["__row_sha"] == again["__sha"])
        single = rows.join(again, match, "left_anti")
        # one row of each set of repeats, by its whole content
        order = F.xxhash64(F.to_json(F.struct(*docs.columns)))
        place = F.row_number().over(Window.partitionBy("doc_id", "__row_sha").orderBy(order))
        repeats = rows.join(again, match, "left_semi").withColumn("__place", place).where("__place = 1").drop("__place")
        rows = single.unionAll(repeats)
    return rows.drop("__row_sha").unionAll(others)
