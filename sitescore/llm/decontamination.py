"""Benchmark decontamination by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a word after lower-casing: digits, a to z and all of non-ASCII.
_SPACED = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_SPACED).split()


class Search:
    """Wu-Manber tables for patterns of one length, counted in words.

    ``shift`` tells for the block of words that ends the window how far the
    window may move on; a block that ends patterns has no shift, and selects the
    bucket of patterns that are compared one by one.
    """

    def __init__(self, patterns: list[tuple[bytes, ...]]):
        self.length = len(patterns[0])
        self.block = min(2, self.length)
        self.most = self.length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, list[tuple[tuple[bytes, ...], int]]] = defaultdict(list)
        for number, pattern in enumerate(patterns):
            for end in range(self.block, self.length + 1):
                key = pattern[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.most), self.length - end)
            self.bucket[pattern[-self.block :]].append((pattern, number))

    def find(self, words: list[bytes]):
        """(first word, number of the pattern) of every occurrence, in order."""
        n, at, most, length, shift = len(words), self.length - 1, self.most, self.length, self.shift
        if self.block == 1:
            for at, word in enumerate(words):
                for _, number in self.bucket.get((word,), ()):
                    yield at, number
            return
        while at < n:
            key = (words[at - 1], words[at])
            step = shift.get(key, most)
            if step:
                at += step
                continue
            first = at - length + 1
            window = tuple(words[first : at + 1])
            for pattern, number in self.bucket[key]:
                if pattern == window:
                    yield first, number
            at += 1


def _blocks(benchmark: DataFrame, block_bytes: int):
    """Items as lists of (item_id, text) of a bounded size each."""
    rows = benchmark.where("text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(size // block_bytes) + 1
    for part in range(parts):
        mine = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield [(r[0], r[1].encode()) for r in mine.collect()]  # block_bytes on average


def _finder(items: list[tuple[str | None, bytes]], window: int) -> Callable[[Column], Column]:
    """Column function: text to struct of the starts and ends of occurrences and the items that occur."""
    owners: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        length = min(window, len(words))
        for at in range(len(words) - length + 1 if length else 0):
            owners[tuple(words[at : at + length])].add(item)
    by_length: dict[int, list[tuple[bytes, ...]]] = defaultdict(list)
    for pattern in owners:
        by_length[len(pattern)].append(pattern)
    tables = [(Search(p), [sorted(owners[x], key=lambda i: i or "") for x in p]) for p in by_length.values()]

    @F.arrow_udf("struct<n_words:long,starts:array<int>,ends:array<int>,items:array<string>>")
    def occurrences(texts: pa.Array) -> pa.Array:
        n_words, starts, ends, found = [], [], [], []
        for text in texts.cast(pa.binary()).to_pylist():
            words = words_of(text or b"")
            runs, names = [], set()
            for search, who in tables:
                for first, number in search.find(words):
                    runs.append((first, first + search.length))
                    names.update(who[number])
            merged: list[list[int]] = []
            for s, e in sorted(runs):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            n_words.append(len(words))
            starts.append([s for s, _ in merged])
            ends.append([e for _, e in merged])
            found.append(sorted(x for x in names if x is not None))
        parts = [pa.array(n_words, pa.int64()), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.string()))]
        return pa.StructArray.from_arrays(parts, ["n_words", "starts", "ends", "items"])

    return occurrences.asNondeterministic()


def _covered(starts: pa.Array, ends: pa.Array) -> pa.Array:
    """Words inside the union of the runs that several blocks found."""
    counts = []
    for s, e in zip(starts.to_pylist(), ends.to_pylist()):
        total, reach = 0, 0
        for a, b in sorted(zip(s, e)):
            total += max(0, b - max(a, reach))
            reach = max(reach, b)
        counts.append(total)
    return pa.array(counts, pa.int64())


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 32 << 20) -> DataFrame:
    """``docs`` with a struct column ``__leak``: n_words, n_hit, items, contaminated.

    Windows are all runs of ``window`` words of an item, or the whole item if it
    has fewer words but not none; a word is hit if it lies in an occurrence of a
    window. Null texts have no words, items with a null id hit words but are not
    listed, items with the same id count once. The benchmark reaches the
    executors in blocks of a bounded size; with more than one block, each is a
    further column over the same rows, without a shuffle.
    """
    names, out = [], docs
    for n, items in enumerate(_blocks(benchmark, block_bytes)):
        names.append(f"__found{n}")
        out = out.withColumn(names[-1], _finder(items, window)(F.col("text")))
    found = [F.col(n) for n in names]
    if len(names) == 1:
        hit = F.aggregate(F.zip_with(found[0]["starts"], found[0]["ends"], lambda s, e: (e - s).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
        items = found[0]["items"]
    else:
        hit = F.arrow_udf(_covered, "long")(F.concat(*[f["starts"] for f in found]), F.concat(*[f["ends"] for f in found]))
        items = F.array_sort(F.array_distinct(F.concat(*[f["items"] for f in found])))
    leak = F.struct(found[0]["n_words"].alias("n_words"), hit.alias("n_hit"), items.alias("items"), (hit > 0).alias("contaminated"))
    return out.withColumn("__leak", leak).drop(*names)


def items_digest(items: Column) -> Column:
    """SHA-256 of the ids, sorted as strings and joined by commas."""
    return F.sha2(F.concat_ws(",", items), 256)


def plain_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
