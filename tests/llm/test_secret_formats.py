"""Learned formats: fresh credentials of each known format are found, ordinary tokens are not."""

import pytest

from sitescore.llm import secret_scan
from tests.llm import reference as ref


def ordinary():
    words = "north river winter garden bridge market station closing opening morning letter history nature promise report summer village window yellow zebra quiet just exact known".split()
    return [f"{a}-{b}{mark}{c}" for n, a in enumerate(words) for b in words for c in words[n % 3 :: 8] for mark in "-_./"[n % 4]]


@pytest.fixture(scope="module")
def formats():
    return secret_scan.Formats(secret_scan.labelled_formats(), ordinary())


@pytest.mark.parametrize("name", secret_scan.KNOWN_FORMATS)
def test_fresh_credentials(formats, name):
    fresh = secret_scan.labelled_formats(200, seed=99)[name]
    assert not set(fresh) & set(secret_scan.labelled_formats()[name])
    assert sum(formats.score(w) > 0 for w in fresh) >= 180


def test_ordinary_tokens(formats):
    words = ["internationalisation", "a-rather-long-file-name.tar.gz", "www.example.org/path/to/some/page", "2024-01-31T00.00.00", "=" * 40, "_" * 30]
    assert not [w for w in (*ordinary(), *words) if formats.score(w) > 0]


def test_early_end_changes_nothing(formats):
    words = [w for some in secret_scan.labelled_formats(20, seed=5).values() for w in some] + ordinary()
    for w in words:
        size = len(w) + 1
        alike = [k for k, t in formats.tables.items() if secret_scan._likelihood(t, w) >= formats.own[k] * size]
        full = any(formats._ratio(formats.tables[k], w) > formats.least[k] for k in alike)
        assert full == (formats.score(w) > 0)


def test_tokens_around_base_matches():
    text = "sk_live_0123456789abcdef0123456789abcdef KEY=" + "Q" * 20 + "== token=abcdefghijkl."
    got = secret_scan.tokens_of(text, secret_scan.base_spans(text))
    assert [(w, touches) for _, _, w, touches in got] == [("sk_live_0123456789abcdef0123456789abcdef", True), ("Q" * 20 + "==", False), ("KEY=" + "Q" * 20 + "==", False)]
    assert all(text[s:e] == w for s, e, w, _ in got)


def test_spans_in_texts(spark, formats):
    fresh = secret_scan.labelled_formats(20, seed=7)
    made = [w for name in ("code_host", "payment_hex", "access_temporary") for w in fresh[name]]
    texts = [f"é the key is {w}. Next, KEY={w}" for w in made] + [" ".join(ordinary()), None, ""]
    frame = spark.createDataFrame([(n, t, None, None, 0, 0, "", "", 0.0) for n, t in enumerate(texts)], ref.SCHEMA)
    found = {r.doc_id: r["__secrets"] for r in secret_scan.find_secrets(frame, formats).collect()}
    whole = 0
    for n, w in enumerate(made):
        spans = [(s.start, s.end) for s in found[n] if s.kind == "inferred"]
        first = texts[n].index(w)
        last = texts[n].rindex(w)
        whole += {(first, first + len(w)), (last, last + len(w))} <= set(spans)
        base = [(s, secret_scan.BASE[k], e) for s, k, e, _ in secret_scan.base_spans(texts[n])]
        assert [(s.start, s.kind, s.end) for s in found[n] if s.kind != "inferred"] == base
    assert whole >= 0.9 * len(made)
    assert not found[len(made)] and not found[len(made) + 1] and not found[len(made) + 2]
