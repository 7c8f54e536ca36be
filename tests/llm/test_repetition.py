"""Repetition rules against plain Python."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from sitescore.llm import repetition
from sitescore.llm.kit import ship, table
from sitescore.llm.queries import QUERIES
from tests.llm import reference as ref

FOLDER = "/root/testdata/sf0.001"
LIMITS = repetition.Limits()


def plain(text):
    """Counts of one text, by tuples of words."""
    words = ref.WORD.findall(text or "")
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or "")}
    seen, lines, again, chars, again_chars = set(), 0, 0, 0, 0
    for line in (text or "").split("\n"):
        if ref.WORD.search(line):
            lines, chars = lines + 1, chars + len(line)
            if line in seen:
                again, again_chars = again + 1, again_chars + len(line)
            seen.add(line)
    out |= {"n_lines": lines, "n_dup_lines": again, "line_chars": chars, "dup_line_chars": again_chars}
    for n in (2, 3, 4, 5, 6, 7, 8, 9, 10):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        count, met, twice, later = Counter(grams), set(), set(), set()
        for i, g in enumerate(grams):
            if count[g] > 1:
                twice.update(range(i, i + n))
                if g in met:
                    later.update(range(i, i + n))
                met.add(g)
        if n == 8:
            out["n_repeat_words"] = len(twice)
        if n in LIMITS.top:
            out[f"top_{n}"] = max((k * sum(map(len, g)) for g, k in count.items() if k > 1), default=0)
        else:
            out[f"again_{n}"] = sum(len(words[i]) for i in later)
    return out


def texts():
    rng = random.Random(5)
    out = [t for _, t, *_ in ref.documents(3, 60)]
    for _ in range(80):
        some = [rng.choice(["a", "bb", "é", "漢字", "#x", "<b>", "nbsp here", "\U0001f600"]) for _ in range(rng.randint(1, 60))]
        out.append("".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in some))
    sentence = " ".join(f"w{i}" for i in range(9))
    return [*out, "\n".join([sentence] * 5), sentence + "\n \n\x0b\n" + sentence, "\n\n\n", "x" * 5000, "word " * 20]


@pytest.mark.parametrize("size", [1 << 20, 300])
def test_counts(spark, size):
    ship(spark)
    every = texts()
    rows = [(i, t, "en", "s", 0, 1, "r", "n", 0.5) for i, t in enumerate(every)]
    frame = spark.createDataFrame(rows, ref.SCHEMA).repartition(3)
    out = repetition.with_repetition(frame, piece_chars=size)
    assert out.columns == [*frame.columns, "__repetition"]
    got = {r.doc_id: r["__repetition"].asDict() for r in out.collect()}
    assert len(got) == len(every)
    for i, text in enumerate(every):
        want = plain(text)
        assert {k: v for k, v in got[i].items() if k in want} == want, text
        assert got[i]["base_failed"] == (want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"])
        assert not (got[i]["base_failed"] and got[i]["kept"])
    assert any(r["kept"] for r in got.values()) and any(r["n_repeat_words"] for r in got.values())
    kept = repetition.drop_repetitive(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r["kept"])
    assert repetition.with_repetition(frame.limit(0)).count() == 0


def test_equal_hashes_of_different_words():
    """Groups are made from the words where rolling hashes meet by accident."""
    hashes = np.arange(1, 13, dtype=np.uint64)
    doc = np.zeros(12, np.int64)
    rolled, repetition.rolled = repetition.rolled, lambda values, width: np.zeros(len(values) - width + 1, np.uint64)
    try:
        grams = repetition.Grams(hashes, doc, 3)
        assert (grams.size == 1).all() and not grams.covered(12, False).any()
        hashes[6:9] = hashes[0:3]
        assert np.flatnonzero(repetition.Grams(hashes, doc, 3).covered(12, False)).tolist() == [0, 1, 2, 6, 7, 8]
    finally:
        repetition.rolled = rolled


def test_slices_of_words():
    words = repetition.Words([b"one two three " * 50, b"", b"x" * 300 + b" y"])
    assert (repetition.word_hashes(words, 7) == words.hashes()).all()


def test_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, FOLDER, "documents").collect()}
    out = QUERIES["op11_quality_rules"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        want = plain(texts[r.doc_id])
        for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
            assert r[name] == want[name]
        assert r.base_failed == (want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"])


def test_verdict_of_methods_own(spark):
    """A repeated sentence that the base rule of eight words cannot see, and prose that stays."""
    ship(spark)
    prose = " ".join(f"word{i}" for i in range(60))
    hidden = " ".join(f"buy these cheap watches now mark{i}" for i in range(12))
    lines = "\n".join(f"line {i} is new here\nmenu home about" for i in range(6))
    quoted = prose + "\nlicense applies to all of this\n" + prose.replace("word", "other") + "\nlicense applies to all of this"
    frame = spark.createDataFrame([(1, prose), (2, hidden), (3, lines), (4, quoted)], "doc_id long, text string")
    got = {r.doc_id: r["__repetition"] for r in repetition.with_repetition(frame).collect()}
    assert [got[i].kept for i in (1, 2, 3, 4)] == [True, False, False, True]
    assert not got[2].base_failed and not got[3].base_failed
