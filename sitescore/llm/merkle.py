"""Merkle manifest of a table by time-forward processing.

The tree is a graph whose nodes are labelled so that each parent comes after its
children. A sweep in the order of the labels takes the digests of a node's
children from a priority queue, and puts the node's own digest back under its
parent's label. A second sweep in the reverse order takes a node's proof suffix
from the queue and puts a longer one under each child's label.

The queue is external. Leaves are sorted by Spark and numbered within their tree;
a block is all nodes under one ancestor a few levels up, so it has a bounded
number of members, however many leaves a tree has. Messages inside a block wait
in a heap of its task. Messages between blocks wait in a written table, which
Spark's shuffle deals out by the label of the block that receives them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitescore.llm.kit import kept

FAN_OUT = 16
#: Levels of a block: 16 ** 3 = 4096 members at most.
BLOCK_LEVELS = 3

NODE = "tree string, place long, digest string"
PATH = "before array<string>, after array<string>, subroot string, root string"


def digest(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def row_digest(*fields: Column) -> Column:
    """SHA-256 of a row: ``-`` for each null field, else its UTF-8 byte count, ``:`` and the value as text."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(leaf: Column, before: Column, after: Column) -> Column:
    """The root that a leaf digest and the siblings on its way give."""
    steps = F.zip_with(before, after, lambda b, a: F.struct(b.alias("b"), a.alias("a")))
    return F.aggregate(steps, leaf, lambda held, s: F.sha2(F.concat(s["b"], held, s["a"]), 256))


def proof_digest(before: Column, after: Column) -> Column:
    """SHA-256 of all siblings on the way, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(before, after, lambda b, a: F.concat(b, a)), ""), 256)


class Block:
    """The nodes under one ancestor. Labels are (level, number within the block)."""

    def __init__(self, digests: Sequence[str], fan_out: int, levels: int | None):
        """With ``levels`` None the sweep ends where one node is left, which may be a lone member."""
        self.fan_out = fan_out
        self.sizes = [len(digests)]
        while self.sizes[-1] > 1 if levels is None else len(self.sizes) <= levels:
            self.sizes.append(-(-self.sizes[-1] // fan_out))
        self.top = len(self.sizes) - 1
        self.nodes = {(0, n): d for n, d in enumerate(digests)}
        self._sweep_up()

    def _sweep_up(self) -> None:
        queue: list[tuple[tuple[int, int], int, str]] = []

        def send(level: int, number: int, value: str) -> None:
            if level < self.top:
                heappush(queue, ((level + 1, number // self.fan_out), number, value))

        for n in range(self.sizes[0]):
            send(0, n, self.nodes[0, n])
        while queue:
            label, children = queue[0][0], []
            while queue and queue[0][0] == label:
                children.append(heappop(queue)[2])
            self.nodes[label] = digest(*children)
            send(*label, self.nodes[label])

    @property
    def root(self) -> str:
        return self.nodes[self.top, 0]

    def sweep_down(self, before: list[str], after: list[str]) -> Iterator[tuple[int, list[str], list[str]]]:
        """(number, before, after) of all members, from what the block's own root received."""
        queue = [((-self.top, 0), before, after)]
        while queue:
            (level, number), before, after = heappop(queue)
            level, number = -level, -number
            if level == 0:
                yield number, before, after
                continue
            begin = number * self.fan_out
            end = min(begin + self.fan_out, self.sizes[level - 1])
            children = [self.nodes[level - 1, c] for c in range(begin, end)]
            for k, c in enumerate(range(begin, end)):
                heappush(queue, ((1 - level, -c), ["".join(children[:k]), *before], ["".join(children[k + 1 :]), *after]))


def _block_of(rows: pa.Table, fan_out: int, levels: int) -> tuple[pa.Table, int, Block]:
    """Members in order, the number of their block, and the block."""
    rows = rows.sort_by("place")
    number = rows["place"][0].as_py() // fan_out**levels
    # blocks fill up in order, so a first block that is not full is the whole tree; a full one ends with one node either way
    whole = number == 0 and rows.num_rows < fan_out**levels
    return rows, number, Block(rows["digest"].to_pylist(), fan_out, None if whole else levels)


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``place``, counted from 0 within ``tree`` by ``order``, nulls first; written.

    Rows are dealt by range, so a tree with a third of all rows is spread over a
    third of the tasks. Only the first tree of a task can have begun in an
    earlier one: the starts are at most one row for each task, so broadcasting
    them is safe.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(tasks, "tree", *order).sortWithinPartitions("tree", *order).withColumn("task", F.spark_partition_id())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, place = None, -1
        for batch in batches:
            places = []
            for found in batch["tree"].to_pylist():
                place = place + 1 if found == tree else 0
                tree = found
                places.append(place)
            yield batch.append_column("place", pa.array(places, pa.int64()))

    schema = ", ".join(f"`{n}` {t}" for n, t in dealt.dtypes) + ", place long"
    counted = kept(dealt.mapInArrow(count, schema), "merkle-order")
    held = counted.groupBy("task", "tree").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("tree").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("task", "tree", F.sum("n").over(earlier).alias("begin")).where("begin > 0")
    placed = counted.join(F.broadcast(starts), on=["task", "tree"], how="left")
    return placed.withColumn("place", F.col("place") + F.coalesce("begin", F.lit(0))).drop("task", "begin")


def _climb(leaves: DataFrame, fan_out: int, levels: int) -> list[DataFrame]:
    """The nodes at each ``levels``-th level, from the leaves up to one root for each tree."""
    size = fan_out**levels

    def ascend(rows: pa.Table) -> pa.Table:
        first, number, block = _block_of(rows, fan_out, levels)
        return pa.table({"tree": first["tree"].slice(0, 1), "place": pa.array([number], pa.int64()), "digest": [block.root]})

    layers = [leaves]
    while True:
        members = layers[-1].select("tree", "place", "digest")
        above = members.groupBy("tree", F.floor(F.col("place") / size)).applyInArrow(lambda rows: ascend(rows), NODE)
        layers.append(kept(above, "merkle-nodes"))
        if not layers[-1].agg(F.max("place")).first()[0]:
            return layers


def _descend(layers: list[DataFrame], paths: DataFrame, carry: str, fan_out: int, levels: int) -> DataFrame:
    """Paths of the leaves from those of the roots, (tree, place, ``PATH``); leaves bring their ``carry`` columns."""
    size = fan_out**levels
    names = [c.split()[0].strip("`") for c in carry.split(", ")]

    def deliver(rows: pa.Table, received: pa.Table, held: list[str]) -> pa.Table:
        rows, _, block = _block_of(rows, fan_out, levels)
        above = received.to_pylist()[0]
        befores, afters = [None] * rows.num_rows, [None] * rows.num_rows
        for n, before, after in block.sweep_down(above["before"], above["after"]):
            befores[n], afters[n] = before, after
        columns = {n: rows[n] for n in ("tree", "place", *held)}
        columns |= {"before": pa.array(befores, pa.list_(pa.string())), "after": pa.array(afters, pa.list_(pa.string()))}
        return pa.table(columns | {n: pa.array([above[n]] * rows.num_rows, pa.string()) for n in ("subroot", "root")})

    for depth in range(len(layers) - 2, -1, -1):
        held = names if depth == 0 else []
        schema = ", ".join(["tree string, place long", *([carry] if held else []), PATH])
        members = layers[depth].select("tree", "place", "digest", *[n for n in held if n != "digest"]).groupBy("tree", F.floor(F.col("place") / size))
        one = (lambda rows, above: deliver(rows, above, names)) if held else (lambda rows, above: deliver(rows, above, []))
        paths = members.cogroup(paths.groupBy("tree", "place")).applyInArrow(one, schema)
    return paths


def manifest(leaves: DataFrame, carry: Sequence[str] = (), fan_out: int = FAN_OUT, levels: int = BLOCK_LEVELS) -> DataFrame:
    """(carry, digest, before, after, subroot, root), one row for each of ``leaves`` (group, key, digest, carry).

    Leaves of a ``group`` (text) ascend by ``key``, null first, equal keys by
    digest; leaves equal in all three are the same leaf to any proof, and each
    keeps a place of its own. While a tree has several nodes, every ``fan_out``
    consecutive ones become the SHA-256 of their digests; the last run may be
    shorter, even one node. What is left of a group is its ``subroot``; subroots,
    ordered by group bytewise with null first, give the ``root`` in the same way.
    ``before`` and ``after`` hold, level by level from the leaf to the root, the
    digests to the left and to the right of the node on the way, run together.
    An empty table gives no rows. Columns other than those named are not read.
    """
    # a mark in front tells a null group from any text and keeps the order
    tree = F.coalesce(F.concat(F.lit("1"), F.col("group")), F.lit("0"))
    # written first: the range sort samples its input, and texts should be hashed once
    rows = leaves.select(tree.alias("tree"), "key", "digest", *[F.col(c).alias(f"carry_{n}") for n, c in enumerate(carry)])
    rows = kept(rows.withColumn("tie", F.monotonically_increasing_id()), "merkle-leaves")
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n == "digest" or n.startswith("carry_"))
    layers = _climb(numbered(rows, ["key", "digest", "tie"]), fan_out, levels)

    subroots = layers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    tops = _climb(numbered(subroots, ["group"]), fan_out, levels)
    none = F.array().cast("array<string>")
    last = tops[-1].select("tree", "place", none.alias("before"), none.alias("after"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    found = _descend(tops, last, "group string, digest string", fan_out, levels)
    first = found.select(F.col("group").alias("tree"), F.lit(0).cast("long").alias("place"), "before", "after", F.col("digest").alias("subroot"), "root")

    paths = _descend(layers, first, schema, fan_out, levels)
    named = [F.col(f"carry_{n}").alias(c) for n, c in enumerate(carry)]
    return paths.select(*named, "digest", "before", "after", "subroot", "root")


def document_manifest(docs: DataFrame, changed_text: Column) -> DataFrame:
    """(doc_id, leaf, changed, before, after, subroot, root) of ``docs``, a tree for each source.

    ``changed`` is the leaf digest with ``changed_text`` as text. Nulls in any of
    the five columns are told from empty texts; null ids come first.
    """
    own = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = docs.select(
        F.col("source").alias("group"),
        F.col("doc_id").alias("key"),
        row_digest(*own, F.col("text")).alias("digest"),
        row_digest(*own, changed_text).alias("changed"),
    )
    found = manifest(leaves, carry=["key", "changed"])
    return found.withColumnsRenamed({"key": "doc_id", "digest": "leaf"})
