"""Near copies: which sets meet, how many rounds they take, and components without rounds."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sitescore.llm.components import _stars, components
from sitescore.llm.jaccard_join import MEMBER, near_copies, sketch
from sitescore.llm.kit import Scratch
from tests.llm import reference as ref


@pytest.fixture
def written(monkeypatch):
    """The names of the tables that are written."""
    names, keep = [], Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, name: names.append(name) or keep(self, df, name))
    return names


def frame(spark, texts):
    return spark.createDataFrame([(d, t, None, None, 0, 0, "", "", 0.0) for d, t in texts], ref.SCHEMA)


def test_common_lines(spark):
    """Long sets with a line in common meet in no cell at 0.8, though each has several cells of one shingle."""
    line = " ".join(f"c{k}" for k in range(24))
    texts = [(n, " ".join(f"w{n}x{k}" for k in range(390 + n)) + " " + line) for n in range(60)]
    found = sketch(frame(spark, texts), 5, 80, 1 << 16)
    assert found.where(F.col("kind") == MEMBER).isEmpty()


@pytest.mark.parametrize("width, percent", [(5, 80), (4, 85), (3, 50)])
def test_sizes(spark, width, percent):
    """Links close to the least similarity, of sets at all places of their bands."""
    rng, texts = random.Random(width), []
    for n in range(150):
        size = rng.randint(8, 500)
        words = [f"w{n}x{k}" for k in range(size)]
        texts.append((2 * n, " ".join(words)))
        most = (100 - percent) * 2 * size // (100 + percent) // (2 * width)
        for _ in range(max(1, most + rng.randint(-2, 1))):
            words[rng.randrange(size)] = "other"
        texts.append((2 * n + 1, " ".join(words)))
    want = ref.near([(d, t) for d, t in texts], width, percent)
    got = near_copies(frame(spark, texts), width, percent, chunk_bytes=50_000).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert 30 < sum(c != d for d, (_, c) in want.items()) < 150


def test_rounds_end(spark, written):
    """Rounds in which few sets join are not repeated."""
    rng, texts = random.Random(9), []
    for n in range(12):
        base = [f"w{n}x{k}" for k in range(200)]
        for k in range(12):
            words = [w if rng.random() > 0.013 else f"o{n}x{k}x{i}" for i, w in enumerate(base)]
            texts.append((100 * n + k, " ".join(words)))
    got = near_copies(frame(spark, texts), few=0).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == ref.near(texts, 4, 85)
    assert 2 <= written.count("open") <= 3 and "clusters" in written


def test_components_of_many_tasks(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(n, n + 1) for n in range(500, 560)]
    least = {n: n for a, b in links if a != b for n in (a, b)}
    for _ in range(100):
        for a, b in links:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    some = components(spark.createDataFrame(links, "a long, b long").repartition(7), task_links=40)
    assert {r.node: r.component for r in some.collect()} == least


def test_components_of_one_task(spark, written):
    """Few links are joined without rounds of stars: one written table."""
    links = spark.createDataFrame([(n, n + 1) for n in range(300)], "a long, b long").repartition(5)
    assert {r.component for r in components(links).collect()} == {0} and written == ["edges"]


def test_stars_start_anew():
    """A task that holds too many nodes hands out what it has."""

    def batch(links):
        return pa.record_batch({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})

    out = list(_stars(iter([batch([(5, 4), (4, 1)]), batch([(9, 5)]), batch([])]), most=2))
    assert [sorted(zip(b["u"].to_pylist(), b["v"].to_pylist())) for b in out] == [[(4, 1), (5, 1)], [(9, 5)]]
