"""Forests that split by absolute error, grown level by level on label histograms.

Spark's own trees know the variance criterion only. Here every level of all trees
is one pass over the rows: each task counts labels by (tree, node, feature, bin),
the counts of a tree meet in one group, whose size depends on bins and depth and
not on the rows, and the best split of each node comes back to the driver. Rows
are never moved or assigned: where a row stands follows from the splits so far,
and how often a tree draws it from a hash of its key.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescore.operators.sampling import SEED
from sitescore.session import cut_lineage

U64 = np.uint64


def spread_bits(x: np.ndarray) -> np.ndarray:
    """Mix 64-bit numbers so that each input bit reaches all output bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def draws(keys: np.ndarray, tree: int, rate: float, bootstrap: bool, seed: int) -> np.ndarray:
    """How often a tree draws each row: Poisson with mean ``rate``, or once with that chance."""
    share = spread_bits(keys ^ spread_bits(np.array([tree * 1000003 + seed + 1], U64))) / 2.0**64
    if not bootstrap:
        return (share < rate).astype(np.int64)
    chances = [math.exp(-rate) * rate**k / math.factorial(k) for k in range(24)]
    return np.searchsorted(np.cumsum(chances), share, side="right")


def chosen_features(tree: int, node: int, features: int, number: int, seed: int) -> np.ndarray:
    """The features a node may split by, ascending."""
    order = spread_bits(np.arange(features, dtype=U64) + U64((tree * 1000003 + node) * 65537 + seed))
    return np.sort(np.argsort(order, kind="stable")[:number])


@dataclass(frozen=True)
class Scale:
    """Candidate thresholds of each feature and the labels that the histograms tell apart."""

    thresholds: tuple[np.ndarray, ...]
    labels: np.ndarray

    @classmethod
    def fit(cls, train: DataFrame, label: str, bins: int = 32, label_bins: int = 64) -> Scale:
        """Approximate quantiles, as many as ``bins``; a value is in bin b if b thresholds lie below it.

        Up to ``label_bins`` different labels are told apart exactly; of more,
        quantiles stand for the labels around them.
        """
        values = vector_to_array("features")
        size = len(train.select(values.alias("v")).first().v)
        steps = [i / bins for i in range(1, bins)]
        marks = train.select(values.alias("v")).agg(*[F.percentile_approx(F.col("v")[i], steps, 10000).alias(f"q{i}") for i in range(size)]).first()
        known = sorted(r[0] for r in train.select(F.col(label).cast("double")).distinct().limit(label_bins + 1).collect())
        if len(known) > label_bins:
            known = train.agg(F.percentile_approx(F.col(label).cast("double"), [i / (label_bins - 1) for i in range(label_bins)], 10000)).first()[0]
        return cls(tuple(np.unique(np.array(marks[i], np.float64)) for i in range(size)), np.unique(np.array(known, np.float64)))

    @property
    def width(self) -> int:
        return 1 + max(len(t) for t in self.thresholds)

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(t, rows[:, i], side="left") for i, t in enumerate(self.thresholds)], axis=1).astype(np.uint8)

    def label_places(self, values: np.ndarray) -> np.ndarray:
        return np.searchsorted((self.labels[1:] + self.labels[:-1]) / 2, values, side="left")


@dataclass
class Forests:
    """Trees as arrays by node; node n has the children 2n and 2n + 1, the root is 1."""

    scale: Scale
    rates: np.ndarray
    bootstrap: np.ndarray
    depth: int
    share: float
    seed: int
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def planted(cls, scale: Scale, rates: Sequence[float], bootstrap: Sequence[bool], depth: int, share: float, seed: int) -> Forests:
        shape = (len(rates), 2 ** (depth + 1))
        return cls(scale, np.array(rates), np.array(bootstrap), depth, share, seed, np.full(shape, -1), np.zeros(shape, np.int64), np.full(shape, np.nan))

    def choice(self, tree: int, node: int) -> np.ndarray:
        features = len(self.scale.thresholds)
        return chosen_features(tree, node, features, max(1, math.ceil(features * self.share)), self.seed)

    def nodes(self, bins: np.ndarray, tree: int, levels: int) -> np.ndarray:
        """The node of each row after ``levels`` splits; a row stays where there is none."""
        at, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
        for _ in range(levels):
            split = self.feature[tree, at]
            goes = split >= 0
            right = bins[rows, np.maximum(split, 0)] > self.cut[tree, at]
            at = np.where(goes, 2 * at + right, at)
        return at

    def predicted(self, bins: np.ndarray) -> np.ndarray:
        """(rows, trees) predictions."""
        return np.stack([self.value[t, self.nodes(bins, t, self.depth)] for t in range(len(self.rates))], axis=1)


def absolute_error(weights: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Least sum of absolute differences, by histogram along the last axis."""
    upto = np.cumsum(weights, axis=-1)
    middle = (2 * upto >= upto[..., -1:]).argmax(axis=-1)
    return (weights * np.abs(labels[None, :] - labels[:, None])[middle]).sum(axis=-1)


def median(weights: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weighted median along the last axis; the mean of both middle labels where the weight parts evenly."""
    upto = np.cumsum(weights, axis=-1)
    low = (2 * upto >= upto[..., -1:]).argmax(axis=-1)
    high = (2 * upto > upto[..., -1:]).argmax(axis=-1)
    return (labels[low] + labels[high]) / 2


def best_splits(counts: np.ndarray, labels: np.ndarray) -> list[tuple[float, int, int, float, float]]:
    """(value, place of the feature or -1, cut, value left, value right) of each node.

    ``counts`` is (node, feature, bin, label). The split that saves most error
    wins; ties go to the first feature, then the lowest cut.
    """
    total = counts[:, 0].sum(axis=1)
    left = np.cumsum(counts, axis=2)[:, :, :-1]
    right = total[:, None, None, :] - left
    saved = absolute_error(total, labels)[:, None, None] - absolute_error(left, labels) - absolute_error(right, labels)
    saved = np.where((left.sum(-1) > 0) & (right.sum(-1) > 0), np.round(saved, 9), -1.0)
    out = []
    for n in range(len(counts)):
        value = float(median(total[n], labels))
        f, cut = np.unravel_index(int(saved[n].argmax()), saved[n].shape) if saved[n].size else (0, 0)
        if saved[n].size and saved[n][f, cut] > 0:
            out.append((value, int(f), int(cut), float(median(left[n, f, cut], labels)), float(median(right[n, f, cut], labels))))
        else:
            out.append((value, -1, 0, value, value))
    return out


def _in_groups(open_nodes: dict[int, list[int]], trees: Forests, most_bytes: int) -> Iterator[dict[int, list[int]]]:
    """The open nodes, tree by tree, in groups whose counts fit into ``most_bytes``."""
    group, held = {}, 0
    for t, nodes in open_nodes.items():
        size = 8 * len(nodes) * len(trees.choice(t, 1)) * trees.scale.width * len(trees.scale.labels)
        if group and held + size > most_bytes:
            yield group
            group, held = {}, 0
        group[t] = nodes
        held += size
    if group:
        yield group


def _level(rows: DataFrame, trees: Forests, level: int, open_nodes: dict[int, list[int]]) -> DataFrame:
    """The best split of each open node of a level, from one pass over ``rows`` (key, label, bins)."""
    scale, first = trees.scale, 2**level
    width, many = scale.width, len(scale.labels)
    choices = {t: np.stack([trees.choice(t, n) for n in nodes]) for t, nodes in open_nodes.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {t: np.zeros(c.size * width * many, np.int64) for t, c in choices.items()}
        for batch in batches:
            keys = batch["key"].to_numpy().view(U64)
            label_at = batch["label"].to_numpy()
            bins = np.frombuffer(b"".join(batch["bins"].to_pylist()), np.uint8).reshape(len(keys), -1)
            for t, choice in choices.items():
                drawn = draws(keys, t, trees.rates[t], bool(trees.bootstrap[t]), trees.seed)
                place = np.full(2 * first, -1)
                place[open_nodes[t]] = np.arange(len(choice))
                at = place[trees.nodes(bins, t, level)]
                some = np.flatnonzero((drawn > 0) & (at >= 0))
                mine = choice[at[some]]
                cells = ((at[some, None] * choice.shape[1] + np.arange(choice.shape[1])) * width + bins[some[:, None], mine]) * many + label_at[some, None]
                np.add.at(held[t], cells.ravel(), np.repeat(drawn[some], choice.shape[1]))
        for t, counts in held.items():
            full = np.flatnonzero(counts)
            if len(full):
                yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "cells": [full.tobytes()], "counts": [counts[full].tobytes()]})

    def settle(found: pa.Table) -> pa.Table:
        t = found["tree"][0].as_py()
        nodes, choice = open_nodes[t], choices[t]
        counts = np.zeros(choice.size * width * many)
        for cells, more in zip(found["cells"].to_pylist(), found["counts"].to_pylist()):
            counts[np.frombuffer(cells, np.int64)] += np.frombuffer(more, np.int64)
        splits = best_splits(counts.reshape(*choice.shape, width, many), scale.labels)
        value, f, cut, left, right = zip(*splits)
        feature = [int(choice[i, p]) if p >= 0 else -1 for i, p in enumerate(f)]
        columns = {"tree": pa.array([t] * len(nodes), pa.int32()), "node": pa.array(nodes, pa.int32()), "feature": pa.array(feature, pa.int32()), "cut": pa.array(cut, pa.int32())}
        return pa.table(columns | {"value": list(value), "left": list(left), "right": list(right)})

    counted = rows.mapInArrow(count, "tree int, cells binary, counts binary")
    return counted.groupBy("tree").applyInArrow(settle, "tree int, node int, feature int, cut int, value double, left double, right double")


def grow(
    train: DataFrame, rates: Sequence[float], bootstrap: Sequence[bool], label: str = "stars", key: str = "site_id", depth: int = 5, share: float = 1 / 3, seed: int = SEED, scale: Scale | None = None, most_bytes: int = 64 << 20
) -> Forests:
    """One tree for each of ``rates``, of at most ``depth`` splits in a row, all grown together.

    Rows are (key, label, features), none of them null. ``share`` of the features
    is open to each node. Keys that repeat are drawn together. The trees depend on
    the rows, the keys and ``seed``, not on partitions or order. A tree that drew
    no row answers with the median of all labels. A task counts for as many trees
    at a time as fit into ``most_bytes``, one at least; the others take further
    passes of the same level.
    """
    if depth > 10:
        raise ValueError("a level's nodes are counted at once; take a depth of 10 or less")
    scale = Scale.fit(train, label) if scale is None else scale
    trees = Forests.planted(scale, rates, bootstrap, depth, share, seed)
    packed = train.select(F.xxhash64(key).alias("key"), F.col(label).cast("double").alias("label"), vector_to_array("features").alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch["v"].to_pylist(), np.float64).reshape(batch.num_rows, len(scale.thresholds))
            places = scale.label_places(batch["label"].to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_pydict({"key": batch["key"], "label": pa.array(places, pa.int64()), "bins": [r.tobytes() for r in scale.bins(rows)]})

    rows = cut_lineage(packed.mapInArrow(pack, "key long, label long, bins binary"))
    for level in range(depth):
        first = 2**level
        open_nodes = {t: [n for n in range(first, 2 * first) if n == 1 or trees.feature[t, n // 2] >= 0] for t in range(len(rates))}
        open_nodes = {t: nodes for t, nodes in open_nodes.items() if nodes}
        if not open_nodes:
            break
        for nodes in _in_groups(open_nodes, trees, most_bytes):
            # one row for each open node: bounded by the trees and the depth
            for r in _level(rows, trees, level, nodes).collect():
                trees.value[r.tree, r.node] = r.value
                if r.feature >= 0:
                    trees.feature[r.tree, r.node], trees.cut[r.tree, r.node] = r.feature, r.cut
                    trees.value[r.tree, 2 * r.node], trees.value[r.tree, 2 * r.node + 1] = r.left, r.right
    idle = np.isnan(trees.value[:, 1])
    if idle.any():
        trees.value[idle, 1] = train.agg(F.percentile(F.col(label).cast("double"), 0.5)).first()[0]
    return trees


def score(trees: Forests, rows: DataFrame, key: str = "site_id") -> DataFrame:
    """(key, prediction): the mean of all trees."""
    kind = dict(rows.dtypes)[key]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array(batch["v"].to_pylist(), np.float64).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch[key], pa.array(trees.predicted(trees.scale.bins(values)).mean(axis=1), pa.float64())], [key, "prediction"])

    return rows.select(key, vector_to_array("features").alias("v")).mapInArrow(predict, f"`{key}` {kind}, prediction double")


def first_trees_metrics(trees: Forests, forests: Sequence[Sequence[int]], rows: DataFrame, counts: Sequence[int], label: str = "stars") -> DataFrame:
    """(forest, trees, rmse, mape, mae) of the first k trees of each forest, for all k of ``counts``, in one pass.

    Labels of 0 drop out of the percentage error.
    """
    wanted = np.array(sorted(counts))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.array(batch["v"].to_pylist(), np.float64).reshape(batch.num_rows, -1)
            y = batch["y"].to_numpy(zero_copy_only=False)[:, None]
            each, shown = trees.predicted(trees.scale.bins(values)), y[:, 0] != 0
            for n, members in enumerate(forests):
                known = wanted[wanted <= len(members)]
                error = np.abs(np.cumsum(each[:, list(members)], axis=1)[:, known - 1] / known - y)
                sums = {"rows": np.full(len(known), len(y)), "squares": (error**2).sum(0), "errors": error.sum(0), "shares": (error[shown] / y[shown]).sum(0), "shown": np.full(len(known), shown.sum())}
                yield pa.RecordBatch.from_pydict({"forest": pa.array([n] * len(known), pa.int32()), "trees": pa.array(known, pa.int32())} | {c: pa.array(v, pa.float64()) for c, v in sums.items()})

    sums = rows.select(F.col(label).cast("double").alias("y"), vector_to_array("features").alias("v")).mapInArrow(
        add_up, "forest int, trees int, rows double, squares double, errors double, shares double, shown double"
    )
    total = sums.groupBy("forest", "trees").agg(*[F.sum(c).alias(c) for c in ("rows", "squares", "errors", "shares", "shown")])
    return total.select(
        "forest",
        "trees",
        F.sqrt(F.try_divide("squares", "rows")).alias("rmse"),
        (100 * F.try_divide("shares", "shown")).alias("mape"),
        F.try_divide("errors", "rows").alias("mae"),
    )
