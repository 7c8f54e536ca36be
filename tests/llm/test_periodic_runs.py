"""Periodic runs against a search over all periods."""

from __future__ import annotations

import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from sitescore.llm import periodic_runs
from sitescore.llm.kit import ship, table
from sitescore.llm.queries import QUERIES
from tests.llm import reference as ref

FOLDER = "/root/testdata/sf0.001"


def plain(words, least=24, power=3):
    """(start, length, period) of all runs, period by period."""
    found = {}
    for p in range(1, len(words) // power + 1):
        s = 0
        while s + p < len(words):
            e = s
            while e + p < len(words) and words[e] == words[e + p]:
                e += 1
            if e - s + p >= max(least, power * p):
                found.setdefault((s, e + p), p)
            s = e + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def strongest(runs):
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None


def words_of(rng):
    """A list of words with planted, nested and neighbouring repetitions."""
    letters = rng.choice([1, 2, 3, 50])
    some = lambda n: [rng.randrange(letters) for _ in range(n)]
    out = some(rng.randint(0, 30))
    for _ in range(rng.randint(0, 4)):
        part = some(rng.randint(1, 40))
        if rng.random() < 0.4:
            part = part + [rng.randrange(letters)] * rng.randint(5, 60) + some(3)
        whole = part * rng.randint(2, 6)
        out += whole[: len(whole) - rng.randint(0, len(part) // 2)]
        out += some(rng.randint(0, 20))
    return out


def test_all_repetitions():
    rng = random.Random(11)
    for trial in range(500):
        words = words_of(rng)
        got = sorted((s, e - s, p) for s, e, p in periodic_runs.repetitions(np.array(words, np.int64)))
        assert got == plain(words, least=3), (trial, words)


def test_words_without_cubes_and_with_many():
    """Thue-Morse and Fibonacci words, powers of periods at and around the scales."""
    morse = [bin(i).count("1") % 2 for i in range(3000)]
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    for words in (morse, b, *[list(range(p)) * 3 + [-1] * 2 + list(range(p)) * 4 for p in (7, 8, 9, 15, 16, 17, 24, 31, 32, 33, 48, 63, 64, 65, 100)]):
        got = sorted((s, e - s, p) for s, e, p in periodic_runs.repetitions(np.array(words, np.int64)))
        assert got == plain(words, least=3)
    assert not [r for r in periodic_runs.repetitions(np.array(morse))]


def test_period_that_holds_a_periodic_stretch():
    """Periods whose larger part repeats one word, so that few places are chosen."""
    for p in range(8, 70):
        for same in range(p // 2, p):
            words = ([0] * same + list(range(1, p - same + 1))) * 3
            got = sorted((s, e - s, q) for s, e, q in periodic_runs.repetitions(np.array([-1, *words, -2])))
            assert (1, 3 * p, p) in got, (p, same)


def frame_of(spark, texts):
    rows = [(i, t, "en", "s", 0, 1, "r", "n", 0.5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, ref.SCHEMA).repartition(3)


@pytest.mark.parametrize("size", [1 << 20, 500])
def test_documents(spark, size):
    ship(spark)
    rng = random.Random(12)
    texts = [t for _, t, *_ in ref.documents(4, 60)]
    texts += [rng.choice([" ", "\n", "  "]).join(f"w{w}é" for w in words_of(rng)) for _ in range(80)]
    frame = frame_of(spark, texts)
    out = periodic_runs.find_runs(frame, piece_chars=size)
    assert out.columns == [*frame.columns, "__runs"]
    got = {r.doc_id: r["__runs"] for r in out.collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = ref.WORD.findall(text or "")
        runs = plain(words)
        assert [tuple(r) for r in got[i].runs] == runs and got[i].n_words == len(words)
        assert (got[i].strongest and tuple(got[i].strongest)) == strongest(runs)
        assert got[i].collapsed == collapsed(words, runs)
    assert sum(len(r.runs) for r in got.values()) > 100
    shorter = {r.doc_id: r.text for r in periodic_runs.collapse_runs(frame).collect()}
    assert all(shorter[i] == (got[i].collapsed if got[i].runs else t) for i, t in enumerate(texts))
    assert periodic_runs.find_runs(frame.limit(0)).count() == 0


def test_other_bounds(spark):
    ship(spark)
    rng = random.Random(13)
    texts = [" ".join(map(str, words_of(rng))) for _ in range(60)]
    got = {r.doc_id: r["__runs"].runs for r in periodic_runs.find_runs(frame_of(spark, texts), least=10, power=4).collect()}
    assert all([tuple(r) for r in got[i]] == plain(t.split(), 10, 4) for i, t in enumerate(texts))
    with pytest.raises(ValueError):
        periodic_runs.runs_in(power=2)


def changed(d, words):
    h = zlib.crc32(str(d).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(d, text):
    words = ref.WORD.findall(text or "")
    words = words if d is None else changed(d, words)
    runs = plain(words)
    s, n, p = strongest(runs) or (None, None, None)
    return (len(runs), s, n, p, 1000 * n // p if runs else None, ref.sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), ref.sha(collapsed(words, runs)))


def test_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, FOLDER, "documents").collect()}
    out = QUERIES["op13_periodic_runs"](spark, FOLDER)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {r.doc_id: tuple(r)[1:] for r in out.collect()}
    assert got == {d: expected(d, t) for d, t in texts.items()}
    assert sum(r[0] > 0 for r in got.values()) > 10


def test_awkward_rows(spark, tmp_path):
    rng = random.Random(14)
    rows = [(None, "a " * 50), (None, None), (7, None), (7, ""), (7, "a " * 50), (7, "a " * 50)]
    rows += [(n, " ".join(rng.choice("ab") for _ in range(rng.randint(1, 200)))) for n in range(200)]
    rows += [(n, " \n\t".join(["é x", " ", "\U0001f600"] * 3)) for n in range(200, 260)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, start int, runs string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(((d, *expected(d, t)) for d, t in rows), key=repr)
