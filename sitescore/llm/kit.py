"""Helpers shared by the text operators: scratch tables, chunks, hashes, key exchange."""

from __future__ import annotations

import math
import os
import tempfile
import zipfile
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from sitescore.session import scratch_path

U64 = np.uint64
#: Odd multipliers of the rolling hashes and of the mixer.
ROLL = U64(0x9E6C63D0876A9A4B)
MIX1, MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as ``--py-files`` does, once for each context."""
    context = spark.sparkContext
    if getattr(context, "_sitescore_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="sitescore-"), "sitescore_code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                archive.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    context._sitescore_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Whether Spark removes the shuffle files of a query as soon as it has run.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_clean(df: DataFrame, path: str) -> None:
    """Write ``df`` and leave none of its shuffle files, which otherwise wait for the driver to collect garbage."""
    conf = df.sparkSession.conf
    former = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, former)


class Scratch:
    """Written tables that live as long as they are needed, and leave no shuffle files.

    A name holds one table. Keeping another one under it removes the former once
    the new one is written, so a table may be made from the one it replaces.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path, former = scratch_path(self.spark, name), self.paths.get(name)
        write_clean(df, path)
        self.paths[name] = path
        if former:
            self._remove(former)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove the tables of these names; nothing unwritten may still read them."""
        for name in names:
            if name in self.paths:
                self._remove(self.paths.pop(name))

    def _remove(self, path: str) -> None:
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


#: Bits of one page of a bitmap, as ``bitmap_construct_agg`` makes them.
PAGE_BITS = 32768


def split_by_keys(rows: DataFrame, key: Column, keys: DataFrame, bits: int = 16, most_pages: int = 4096) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose ``key`` may be the only column of ``keys``, and those whose is not.

    What is looked up in ``keys`` next, however large they are, need not move the
    second part. A bitmap of about ``bits`` bits for each key goes to all tasks,
    so about one in ``bits`` of the other rows comes to the first part too. Of
    more than ``most_pages`` pages of 4 KB, the bitmap only gets denser.
    """
    pages = min(most_pages, max(1, math.ceil(keys.count() * bits / PAGE_BITS)))
    place = F.pmod(F.xxhash64(key), F.lit(pages * PAGE_BITS))
    page, bit = F.expr(f"__place div {PAGE_BITS}"), (F.col("__place") % PAGE_BITS).cast("int")
    named = keys.toDF("__key").select(F.pmod(F.xxhash64("__key"), F.lit(pages * PAGE_BITS)).alias("__place"))
    bitmap = kept(named.groupBy(page.alias("__page")).agg(F.bitmap_construct_agg(bit).alias("__bits")), "bitmap")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.expr(f"cast(__place % {PAGE_BITS} div 8 as int) + 1"), F.lit(1))), 16, 10).cast("int")
    held = F.coalesce(F.getbit(byte, bit % 8) == 1, F.lit(False))
    told = rows.withColumn("__place", place).withColumn("__at", page).join(F.broadcast(bitmap), F.col("__at") == F.col("__page"), "left")
    told = told.select(*rows.columns, held.alias("__held"))
    return told.where("__held").drop("__held"), told.where("not __held").drop("__held")


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word64(x: int) -> np.uint64:
    return U64(x & (2**64 - 1))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    x = (x ^ (x >> U64(30))) * MIX1
    x = (x ^ (x >> U64(27))) * MIX2
    return x ^ (x >> U64(31))


_LANES = np.zeros(0, U64)


def _lanes(n: int) -> np.ndarray:
    """One fixed odd multiplier for each place in a word."""
    global _LANES
    if len(_LANES) < n:
        size = max(1024, 2 * n)
        _LANES = mix(np.arange(1, size + 1, dtype=U64) * ROLL) | U64(1)
    return _LANES[:n]


class Words:
    """The words of several texts: bytes between ASCII white space, hashed.

    ``data`` holds the texts end to end, each followed by a line feed; word ``i``
    is ``data[start[i]:end[i]]`` and belongs to text ``doc[i]``; the words of
    text ``d`` are ``first[d]:first[d + 1]``.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b"\n".join(texts) + b"\n"
        if lower:
            joined = joined.lower()
        self.data = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        edge = np.cumsum(sizes)
        gap = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        turn = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if len(gap) and not gap[0]:
            turn = np.concatenate(([0], turn))
        self.start, self.end = turn[0::2], turn[1::2]
        self.first = np.concatenate(([0], np.searchsorted(self.start, edge)))
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, U64)
        size = self.end - self.start
        inside = np.arange(int(size.sum()), dtype=np.int64)
        begin = np.cumsum(size) - size
        place = inside - np.repeat(begin, size)
        letters = self.data[np.repeat(self.start, size) + place].astype(U64) + U64(1)
        letters *= _lanes(int(size.max()))[place]
        return mix(np.add.reduceat(letters, begin) + size.astype(U64) * ROLL)


def rolled(values: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every window of ``width`` values, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    hashes, have, power, part, left = None, 0, ROLL, values, width
    size = 1
    while left:
        if left & 1:
            if hashes is None:
                hashes = part
            else:
                m = len(part) - have
                hashes = hashes[:m] * power + part[have : have + m]
            have += size
        left >>= 1
        if left:
            part = part[: len(part) - size] * power + part[size:]
            size *= 2
            power = word64(int(power) ** 2)
    return mix(hashes[:n])


def row_key() -> Column:
    """Names a row by its id and whole text; rows that repeat both share it."""
    return F.xxhash64(F.col("doc_id").cast("long"), whole_text())


def chunked(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """(chunk, row, doc_id, text) with every row in one of many chunks of about equal size."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    chunks = max(1, math.ceil(size / chunk_bytes))
    rows = rows.withColumn("row", row_key())
    return rows.select(F.pmod("row", F.lit(chunks)).cast("int").alias("chunk"), "row", "doc_id", "text")


#: Stands for a null id where ids are compared: null comes first.
NO_ID = -(2**63)


def read_chunk(rows: pa.Table) -> tuple[list, list, list[bytes]]:
    """Ids, row keys and texts of a chunk, in a fixed order: by id, null first, then by row key."""
    ids, keys = rows["doc_id"].to_pylist(), rows["row"].to_pylist()
    texts = rows["text"].cast(pa.binary()).to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (NO_ID if ids[i] is None else ids[i], keys[i]))
    return [ids[i] for i in order], [keys[i] for i in order], [texts[i] for i in order]


BLOBS = "bucket int, chunk int, keys binary, notes binary"
FLAGS = "chunk int, bucket int, flags binary"


def first_places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different key occurs first, ascending, and how often it occurs."""
    order = np.argsort(keys, kind="stable")
    run = keys[order]
    fresh = np.ones(len(run), bool)
    fresh[1:] = run[1:] != run[:-1]
    begin = np.flatnonzero(fresh)
    places, counts = order[begin], np.diff(np.append(begin, len(run)))
    back = np.argsort(places)
    return places[back], counts[back]


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """By a hash of its own, so that the bucket adds to what a key tells apart."""
    return ((mix(keys ^ ROLL) >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts keys bucket by bucket, and where each bucket begins."""
    bucket = _bucket(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _blobs(chunk: int, keys: np.ndarray, notes: np.ndarray, buckets: int) -> pa.Table:
    order, cuts = _dealt(keys, buckets)
    keys, notes = keys[order], notes[order]
    rows = [(b, s, e) for b, (s, e) in enumerate(zip(cuts[:-1], cuts[1:])) if e > s]
    return pa.table(
        {
            "bucket": pa.array([b for b, _, _ in rows], pa.int32()),
            "chunk": pa.array([chunk] * len(rows), pa.int32()),
            "keys": pa.array([keys[s:e].tobytes() for _, s, e in rows], pa.binary()),
            "notes": pa.array([notes[s:e].tobytes() for _, s, e in rows], pa.binary()),
        }
    )


def _decide(rows: pa.Table, hot: int | None) -> pa.Table:
    """Flags for the keys of one bucket, as :func:`exchange_keys` says."""
    rows = rows.sort_by("chunk")
    parts = [np.frombuffer(b, U64) for b in rows["keys"].to_pylist()]
    keys = np.concatenate(parts)
    notes = np.concatenate([np.frombuffer(b, np.int64 if hot is None else np.uint16) for b in rows["notes"].to_pylist()])
    order = np.argsort(keys, kind="stable")
    run = keys[order]
    fresh = np.ones(len(run), bool)
    fresh[1:] = run[1:] != run[:-1]
    flag = np.zeros(len(keys), np.uint8)
    if hot is None:
        shared = ~fresh
        shared[:-1] |= ~fresh[1:]
        some = order[shared]
        some = some[np.lexsort((some, notes[some], keys[some]))]
        flag[some[1:][keys[some[1:]] == keys[some[:-1]]]] = 1
    else:
        total = np.add.reduceat(notes[order].astype(np.int64), np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
        flag[order] = (total > 1).astype(np.uint8) + (total >= hot)
    ends = np.cumsum([len(p) for p in parts])
    told = [flag[e - len(p) : e] for p, e in zip(parts, ends)]
    told = pa.array([f.tobytes() if f.any() else None for f in told], pa.binary())
    return pa.table({"chunk": rows["chunk"], "bucket": rows["bucket"], "flags": told}).filter(told.is_valid())


def exchange_keys(
    chunks: DataFrame,
    keys_of: Callable[[pa.Table], tuple[np.ndarray, np.ndarray, Any]],
    finish: Callable[[Any, np.ndarray], pa.Table],
    schema: str,
    hot: int | None = None,
    aside: DataFrame | None = None,
) -> DataFrame:
    """Let all chunks learn which of their 64-bit keys other chunks hold too.

    ``keys_of(rows)`` gives the different keys of a chunk, a note for each, and
    what ``finish`` needs. The keys go to buckets in packed form, each key once
    for a chunk however often the chunk holds it, so a key that a third of all
    rows share arrives once for each chunk. ``finish`` then gets one flag for
    each key of the chunk. Without ``hot`` a note is the id of the key's first
    holder, and a flag of 1 says that another chunk holds the key under a
    smaller id (of equal ids, the smaller chunk's). With ``hot`` a note is how
    often the chunk holds the key, and a flag is 0 for a key that exists once, 2
    for one that exists ``hot`` times or more, else 1. Rows of ``aside``, with -1
    as bucket, hand ``keys_of`` more bytes about a chunk.
    """
    buckets = max(1, int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    empty, nothing = (to_arrow_schema(_parse_datatype_string(x)).empty_table() for x in (schema, BLOBS))

    plain = aside is None

    def read(rows: pa.Table, told: pa.Table | None):
        if plain:
            return keys_of(rows)
        return keys_of(rows, told.filter(pa.compute.equal(told["bucket"], -1))["flags"].to_pylist())

    def send(rows: pa.Table, told: pa.Table | None = None) -> pa.Table:
        if not rows.num_rows:
            return nothing
        keys, notes, _ = read(rows, told)
        notes = notes.astype(np.int64) if hot is None else np.minimum(notes, 65535).astype(np.uint16)
        return _blobs(rows["chunk"][0].as_py(), keys, notes, buckets)

    def decide(rows: pa.Table) -> pa.Table:
        return _decide(rows, hot)

    def end(rows: pa.Table, told: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return empty
        keys, _, state = read(rows, told)
        order, cuts = _dealt(keys, buckets)
        flags = np.zeros(len(keys), np.uint8)
        pa.default_memory_pool().release_unused()
        for b, found in zip(told["bucket"].to_pylist(), told["flags"].to_pylist()):
            if b < 0:
                continue
            flags[order[cuts[b] : cuts[b + 1]]] = np.frombuffer(found, np.uint8)
        return finish(state, flags)

    if aside is None:
        sent = chunks.groupBy("chunk").applyInArrow(lambda rows: send(rows), BLOBS)
    else:
        sent = chunks.groupBy("chunk").cogroup(aside.groupBy("chunk")).applyInArrow(send, BLOBS)
    told = sent.groupBy("bucket").applyInArrow(decide, FLAGS)
    told = told if aside is None else told.unionAll(aside)
    return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(end, schema)


def copied_texts(chunks: DataFrame) -> DataFrame:
    """For each chunk, one byte for each row: 1 if an equal text stands earlier, by id, in another row.

    In the form of ``aside``; texts compare by 64 bits and the bucket.
    """

    def keys_of(rows: pa.Table):
        ids, _, texts = read_chunk(rows)
        hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], U64)
        first, _ = first_places(hashes)
        order = np.array([NO_ID if i is None else i for i in ids], np.int64)
        return hashes[first], order[first], (rows["chunk"][0].as_py(), len(ids), first)

    def finish(state, later: np.ndarray) -> pa.Table:
        chunk, size, first = state
        copy = np.ones(size, np.uint8)
        copy[first] = later > 0
        return pa.table({"chunk": pa.array([chunk], pa.int32()), "bucket": pa.array([-1], pa.int32()), "flags": pa.array([copy.tobytes()], pa.binary())})

    return exchange_keys(chunks, keys_of, finish, FLAGS)
