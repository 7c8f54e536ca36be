"""The Merkle manifest against a plain recursive tree."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from sitescore.llm import merkle
from sitescore.llm.kit import ship, table
from sitescore.llm.queries import QUERIES
from tests.llm import reference as ref

FOLDER = "/root/testdata/sf0.001"


def tree(digests, fan_out):
    """(root, siblings before and after on the way up for each node), level by level."""
    ways = [([], []) for _ in digests]
    place, level = list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, p in enumerate(place):
            begin = p // fan_out * fan_out
            ways[i][0].append("".join(level[begin:p]))
            ways[i][1].append("".join(level[p + 1 : begin + fan_out]))
        level = [ref.sha("".join(level[k : k + fan_out])) for k in range(0, len(level), fan_out)]
        place = [p // fan_out for p in place]
    return level[0], ways


def forest(rows, fan_out):
    """{(group, key, digest, n-th of these): (before, after, subroot, root)} of (group, key, digest) rows."""
    groups = {}
    for group, key, digest in rows:
        groups.setdefault(group, []).append((key is not None, key or 0, digest))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    grown = {g: tree([d for *_, d in sorted(groups[g])], fan_out) for g in names}
    root, tops = tree([grown[g][0] for g in names], fan_out)
    out = []
    for g, (top_before, top_after) in zip(names, tops):
        for (has, key, digest), (before, after) in zip(sorted(groups[g]), grown[g][1]):
            out.append((key if has else None, digest, before + top_before, after + top_after, grown[g][0], root))
    return out


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("fan_out,levels", [(2, 1), (2, 3), (3, 2), (16, 3)])
def test_forest(spark, fan_out, levels):
    ship(spark)
    rng = random.Random(fan_out * levels)
    sizes = {"hot": 90, "eight": fan_out**levels, "nine": min(fan_out**levels, 64) + 1, "": 1, None: 5, "Éa": 2, "a": 3, "~": 4}
    rows = []
    for group, size in sizes.items():
        rows += [(group, rng.choice([None, *range(40)]), ref.sha(str(rng.randrange(30))), "other") for _ in range(min(size, 200))]
    frame = spark.createDataFrame(rows, "group string, key long, digest string, before string").repartition(4)
    got = merkle.manifest(frame, ["key"], fan_out, levels).collect()
    assert ordered(tuple(r) for r in got) == ordered(forest([r[:3] for r in rows], fan_out))
    assert merkle.manifest(frame.limit(0), ["key"], fan_out, levels).count() == 0


def test_fold(spark):
    ship(spark)
    frame = spark.createDataFrame([("g", n, ref.sha(str(n))) for n in range(40)], "group string, key long, digest string")
    way = (F.col("before"), F.col("after"))
    found = merkle.manifest(frame, ["key"]).select("key", "root", merkle.fold(F.col("digest"), *way).alias("ours"), merkle.fold(F.sha2("root", 256), *way).alias("wrong"))
    for r in found.collect():
        assert r.ours == r.root != r.wrong


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def expected(rows):
    """Contract rows of (doc_id, text, lang, source, n_chars) rows with different leaves."""
    leaf = {}
    for d, text, lang, source, n in rows:
        changed = text
        if d is not None and zlib.crc32(str(d).encode()) % 5 == 0:
            changed = text and text.encode().lower().decode()
        leaf[source, d, ref.sha("".join(map(field, (d, source, lang, n, text))))] = ref.sha("".join(map(field, (d, source, lang, n, changed))))
    changed = {(d, digest): c for (_, d, digest), c in leaf.items()}
    out = []
    for d, digest, before, after, subroot, root in forest(list(leaf), 16):
        folded = changed[d, digest]
        for b, a in zip(before, after):
            folded = ref.sha(b + folded + a)
        out.append((d, digest, subroot, root, ref.sha("".join(b + a for b, a in zip(before, after))), folded, folded == root))
    return out


def test_query(spark):
    docs = table(spark, FOLDER, "documents")
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    got = [tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, FOLDER).collect()]
    assert ordered(got) == ordered(expected(rows))
    assert len({r[3] for r in got}) == 1 and {r[6] for r in got} == {True, False}


def test_awkward_rows(spark, tmp_path):
    """Nulls in all columns, empty texts, a lone source, repeated ids and extra columns."""
    rows = [(None, None, None, None, None), (5, "", "en", "s", 0), (5, None, "en", "s", 0), (5, "ÀB", None, "s", 1), (15, "AbC", "en", None, 3), (None, "x", "en", "t", None)]
    rows += [(n, f"Text {n}", "en", "s", n) for n in range(20, 60)]
    clashing = [(*r, "a", "b", 1) for r in rows]
    frame = spark.createDataFrame(clashing, "doc_id long, text string, lang string, source string, n_chars long, tree string, digest string, place int")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, str(tmp_path)).collect()]
    assert ordered(got) == ordered(expected(rows))


def test_repeated_rows(spark):
    """Rows equal in everything keep one row and one place each."""
    ship(spark)
    rows = [("g", 1, ref.sha("same"))] * 20 + [("g", 2, ref.sha("other"))]
    got = merkle.manifest(spark.createDataFrame(rows, "group string, key long, digest string"), ["key"], 4, 1).collect()
    assert ordered(tuple(r) for r in got) == ordered(forest(rows, 4))
