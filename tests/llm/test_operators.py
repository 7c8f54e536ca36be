"""Every text operator against brute force on rows with nulls, ties, repeats, long texts and clashing columns."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitescore.llm import automata, html_text, secret_scan, warc
from sitescore.llm.components import components
from sitescore.llm.decontamination import Search, find_benchmark
from sitescore.llm.exact_dedup import drop_copies, exact_dedup
from sitescore.llm.jaccard_join import _forest, _joining_links, bands, cells, drop_near_copies, near_copies, near_links
from sitescore.llm.kit import Scratch, ship
from sitescore.llm.language_id import held_out, identify
from sitescore.llm.mixing import mix_sources, targets
from sitescore.llm.substring_dedup import remove_repeats
from sitescore.llm.suffix_dedup import remove_repeated_bytes
from sitescore.llm.suffix_order import grouped_suffix_order
from tests.llm import reference as ref


@pytest.fixture(scope="module")
def rows():
    return ref.documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    ship(spark)
    return spark.createDataFrame(rows, ref.SCHEMA).repartition(3, "doc_id").cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def awkward(spark):
    """Null and repeated ids."""
    long = " ".join(f"w{n}" for n in range(60))
    texts = [(None, long), (None, long), (7, long), (7, long), (7, "other"), (8, None), (None, None), (9, long.upper())]
    return spark.createDataFrame([(d, t, "en", "s", 0, 1, "r", "n", 0.5) for d, t in texts], ref.SCHEMA)


@pytest.mark.parametrize("block", [4096, 16])
def test_exact_dedup(docs, rows, block):
    texts = {d: ref.lowered(t) for d, t, *_ in rows}
    groups = {}
    for d, t in texts.items():
        groups.setdefault(t, []).append(d)
    got = {r.doc_id: r for r in exact_dedup(docs, block).collect()}
    assert len(got) == len(rows)
    for d, t in texts.items():
        same = groups[t]
        assert tuple(got[d]) == (d, max(same), len(same), d == max(same), ref.sha(t))
    kept = drop_copies(docs, block)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(max(g) for g in groups.values())


def test_exact_dedup_ties(awkward, empty):
    got = exact_dedup(awkward, 16).collect()
    assert len(got) == 8 and sum(r.kept for r in got) == 3
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got if r.group_size == 5} == {(None, 9, 5), (7, 9, 5), (9, 9, 5)}
    assert sorted((r.doc_id, (r.text or "")[:5]) for r in drop_copies(awkward).collect() if r.doc_id) == [(7, "other"), (8, ""), (9, "W0 W1")]
    assert drop_copies(awkward.unionAll(awkward)).count() == 3
    assert exact_dedup(empty).count() == 0 and drop_copies(empty).count() == 0


def test_exact_dedup_is_native(docs):
    plan = exact_dedup(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("chunk_bytes", [8 << 20, 4000])
def test_substring_dedup(docs, rows, chunk_bytes):
    want = ref.substring(rows, 20)
    got = {r.doc_id: r for r in remove_repeats(docs, chunk_bytes=chunk_bytes).collect()}
    assert {d: (r.n_words, r.n_removed, r.kept) for d, r in got.items()} == want
    assert sum(n for _, n, _ in want.values()) > 500
    for r in got.values():
        assert sum(e - s for s, e in zip(r.starts, r.ends)) == r.n_removed


def test_substring_dedup_ties(awkward, empty):
    got = remove_repeats(awkward, chunk_bytes=200).collect()
    assert len(got) == 8 and sorted(r.n_removed for r in got) == [0, 0, 0, 0, 0, 60, 60, 60]
    assert [r.doc_id for r in got if r.n_words == 60 and not r.n_removed and r.kept.islower()] == [None]
    assert remove_repeats(empty).count() == 0


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 4000}, {"chunk_bytes": 4000, "hot": 3}, {"chunk_bytes": 3000, "hot": 1 << 20, "most": 2}])
def test_suffix_dedup(docs, rows, options):
    want = ref.repeated_bytes(rows, 80)
    got = remove_repeated_bytes(docs, window=80, gram=24, **options).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == want
    assert sum(n for _, n, _, _ in want.values()) > 2000


def test_suffix_dedup_ties(awkward, empty):
    got = remove_repeated_bytes(awkward, chunk_bytes=200).collect()
    assert sorted(r.n_removed for r in got) == [0, 0, 0, 0, 229, 229, 229, 229]
    assert remove_repeated_bytes(empty).count() == 0


def test_suffix_order():
    rng = random.Random(2)
    for trial in range(60):
        texts = []
        for _ in range(rng.randint(1, 5)):
            text = [rng.randint(1, rng.choice([1, 2, 3, 26])) for _ in range(rng.randint(0, 50))]
            texts.append((text * 3 if trial % 3 == 0 else text) + [0])
        off = np.cumsum([0] + [len(t) for t in texts])
        got = grouped_suffix_order(np.array([c for t in texts for c in t]), off)
        for t, o in zip(texts, off):
            assert (got[o : o + len(t)] - o).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 3000, "few": 0}, {"chunk_bytes": 3000, "star_rounds": 0}])
def test_jaccard_join(docs, rows, options):
    want = ref.near(rows, 4, 85)
    got = near_copies(docs, **options).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) < len(rows) - 10


def link_counts(rows, width, percent):
    """How many other rows each row links with, by brute force."""
    sets = []
    for _, text, *_ in rows:
        words = ref.WORD.findall(ref.lowered(text))
        sets.append({tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set())
    return [sum(i != j and 100 * len(a & b) >= percent * len(a | b) for j, b in enumerate(sets)) if a else 0 for i, a in enumerate(sets)]


def family(n, size=120, first=0):
    """Texts that differ in one place each, so that all pairs link."""
    words = [f"w{first}x{k}" for k in range(size)]
    texts = [" ".join([*words[: 6 * k], f"other{k}", *words[6 * k + 1 :]]) for k in range(n)]
    return [(first + k, t, None, None, 0, 0, "", "", 0.0) for k, t in enumerate(texts)]


@pytest.mark.parametrize("block", [256, 3])
def test_jaccard_links(docs, rows, spark, block):
    """All links are found, also those inside a component."""
    more = family(18, first=10_000)
    more += [(20_000 + r[0], r[1].upper(), *r[2:]) for r in more[:3]]
    got = near_links(docs.unionAll(spark.createDataFrame(more, ref.SCHEMA)), chunk_bytes=6000, block=block).collect()
    both = [*rows, *more]
    want = {r[0]: n for r, n in zip(both, link_counts(both, 4, 85))}
    assert {r.doc_id: r.n_links for r in got} == want and want[10_000] == 20
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == ref.near(both, 4, 85)


def test_jaccard_links_ties(awkward, empty):
    got = [(r.doc_id, r.component_id, r.n_links) for r in near_links(awkward, chunk_bytes=200).collect()]
    assert sorted(got, key=str) == sorted([(None, 7, 4), (None, 7, 4), (7, 7, 4), (7, 7, 4), (7, 7, 0), (8, 8, 0), (None, None, 0), (9, 7, 4)], key=str)
    assert near_links(empty).count() == 0


def test_drop_near_copies_ties(spark, awkward):
    """One row of each component stays, whatever its ids."""
    long = [f"w{n}" for n in range(60)]
    other = " ".join([*long[:-1], "x"])
    texts = [(7, " ".join(long)), (7, other), (None, "a b c d e"), (None, "A b c d e"), (None, "a b c d e"), (5, "..."), (None, ""), (None, "")]
    frame = spark.createDataFrame([(d, t, None, None, 0, 0, "", str(k), 0.0) for k, (d, t) in enumerate(texts)], ref.SCHEMA)
    left = drop_near_copies(frame)
    assert left.columns == frame.columns
    got = [r.doc_id for r in left.where("text <> ''").collect()]
    assert sorted(got, key=str) == [5, 7, None] and left.where("text = ''").count() == 2
    # of the awkward rows: one of the long texts, "other" and the two without text
    assert sorted((str(r.doc_id), (r.text or "")[:2]) for r in drop_near_copies(awkward).collect()) == [("7", "ot"), ("7", "w0"), ("8", ""), ("None", "")]


def test_jaccard_small_sets(spark):
    """Sets of a few shingles, where cells are often empty."""
    rng = random.Random(4)
    rows = []
    for n in range(250):
        base = [f"w{rng.randint(0, 3)}" for _ in range(rng.randint(4, 30))]
        rows.append((2 * n, " ".join(base), None, None, 0, 0, "", "", 0.0))
        base[rng.choice([0, -1])] = "other"
        rows.append((2 * n + 1, " ".join(base), None, None, 0, 0, "", "", 0.0))
    got = near_copies(spark.createDataFrame(rows, ref.SCHEMA), width=2, percent=60, chunk_bytes=5000).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == ref.near(rows, 2, 60)


def joined(links, nodes):
    """Smallest node reached by links, for each node."""
    least = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return least


@pytest.mark.parametrize("block, block_values", [(1024, 1 << 19), (7, 1 << 19), (1024, 300)])
def test_joining_links(spark, block, block_values):
    """One cell whose sets meet in blocks: its links join what all links join, and none is false."""
    rng = np.random.default_rng(6)
    base = [np.unique(rng.integers(0, 1 << 62, 60, dtype=np.uint64)) for _ in range(4)]
    sets = {n: np.unique(np.concatenate((base[n % 4][: 60 - n // 4], rng.integers(0, 1 << 62, n // 4, dtype=np.uint64)))) for n in range(40)}
    component = {n: 5 if n in (5, 9, 13) else n for n in sets}
    cells_of = [(1, 0, 1, -1, n, len(t), component[n], len(sets)) for n, t in sets.items()]
    labelled = spark.createDataFrame(cells_of, "key long, part int, need int, most_apart int, node long, n long, component long, held long")
    tokens = spark.createDataFrame([(n, bytearray(t.tobytes())) for n, t in sets.items()], "node long, tokens binary")
    got = [(r.a, r.b) for r in _joining_links(labelled, tokens, 80, Scratch(spark), block, block_values).collect()]
    share = lambda a, b: len(np.intersect1d(sets[a], sets[b]))
    links = [(a, b) for a in sets for b in sets if a < b and 100 * share(a, b) >= 80 * (len(sets[a]) + len(sets[b]) - share(a, b))]
    inside = [(5, 9), (9, 13)]
    assert set(got) <= set(links) and joined(got + inside, sets) == joined(links + inside, sets)
    assert len(set(joined(links, sets).values())) > 4 and len(links) > len(sets)


def test_forest():
    rng = np.random.default_rng(3)
    for trial in range(50):
        near = rng.random((rng.integers(1, 12), rng.integers(1, 12))) < rng.random() / 2
        names = [*(("r", i) for i in range(near.shape[0])), *(("c", j) for j in range(near.shape[1]))]
        every, some = ([(("r", int(i)), ("c", int(j))) for i, j in found] for found in (np.argwhere(near), _forest(near)))
        assert set(some) <= set(every) and len(some) < len(names) and joined(some, names) == joined(every, names)


def test_bands_hold_every_link():
    low = bands(3000, 85)
    band = np.searchsorted(low, np.arange(3001), "right") - 1
    for a in range(1, 1500):
        b = np.arange(a, min(3000, a * 100 // 85) + 1)
        assert (band[b] - band[a] <= 1).all()
        for cross in (False, True):
            mine = b[band[b] == band[a] + cross]
            if len(mine):
                d, e, count = cells(low, band[a : a + 1], cross, 85)
                assert (15 * (a + mine) // 185).max() <= d[0] and count[0] == d[0] + e[0] + 1


def test_jaccard_ties(awkward, empty, docs, rows):
    got = [(r.doc_id, r.component_id) for r in near_copies(awkward, chunk_bytes=200).collect()]
    assert sorted(got, key=str) == sorted([(None, 7), (None, 7), (7, 7), (7, 7), (7, 7), (8, 8), (None, None), (9, 7)], key=str)
    assert near_copies(empty).count() == 0 and drop_near_copies(empty).count() == 0
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (_, c) in ref.near(rows, 4, 85).items() if d == c)


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(n, n + 1) for n in range(500, 560)]
    parent = {n: n for link in links for n in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: root(n) for a, b in links if a != b for n in (a, b)}


@pytest.mark.parametrize("block_bytes", [1 << 25, 60])
def test_decontamination(docs, rows, spark, block_bytes):
    rng = random.Random(5)
    items = [(n, " ".join((rows[rng.randrange(16, len(rows))][1] or "").split()[: rng.choice([3, 9, 10, 25])])) for n in range(12)]
    items += [(100, None), (101, "..."), (102, "ONE"), (102, "two-words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r["__leak"] for r in find_benchmark(docs, bench, block_bytes=block_bytes).collect()}
    want = ref.leaks(rows, items, 10)
    assert {d: (r.n_words, r.n_hit, sorted(r["items"])) for d, r in got.items()} == want
    assert all(r.contaminated == (r.n_hit > 0) for r in got.values()) and any(r.contaminated for r in got.values())
    none = find_benchmark(docs, bench.limit(0)).where("__leak.contaminated")
    assert none.count() == 0


def test_wu_manber():
    rng = random.Random(6)
    for length in (1, 2, 3, 6):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(400)]
        patterns = sorted({tuple(rng.choice([b"a", b"b", b"c"]) for _ in range(length)) for _ in range(8)})
        got = sorted(Search(patterns).find(words))
        assert got == sorted((k, n) for k in range(400 - length + 1) for n, p in enumerate(patterns) if tuple(words[k : k + length]) == p)


def test_language_id(spark, empty, awkward):
    rng = random.Random(8)
    letters = {"xx": "abcdeé", "yy": "abcdoü"}
    rows = []
    for n in range(400):
        lang = rng.choice(list(letters))
        text = " ".join("".join(rng.choice(letters[lang]) for _ in range(5)) for _ in range(rng.randint(3, 40)))
        rows.append((n, text, lang if n % 7 else None, "s", 0, 0, lang, "", 0.0))
    rows += [(1000, None, "xx", "s", 0, 0, "und", "", 0.0), (1001, "", "yy", "s", 0, 0, "und", "", 0.0), (1002, "12 .. !", "yy", "s", 0, 0, "und", "", 0.0)]
    ship(spark)
    frame = spark.createDataFrame(rows, ref.SCHEMA)
    found = identify(frame).select("*", held_out().alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert sum(r["__language"].lang_pred == r.row for r in found) >= 0.99 * len(found)
    assert all(r["__language"].lang_pred == "und" and r["__language"].score == 0 for r in found if r.doc_id >= 1000)
    assert all(0 <= r["__language"].score <= 1 for r in found)
    assert identify(empty).count() == 0
    nothing = identify(awkward.withColumn("lang", F.lit(None).cast("string")))
    assert {r["__language"].lang_pred for r in nothing.collect()} == {"und"}


def test_language_id_keeps_labels_out(spark, docs):
    """Predictions of held-out rows do not change with their labels."""
    a = identify(docs).where(held_out()).select("doc_id", "__language").collect()
    other = docs.withColumn("lang", F.when(held_out(), "zz").otherwise(F.col("lang")))
    b = identify(other).where(held_out()).select("doc_id", "__language").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_mixing(docs, rows):
    size = {d: len(ref.WORD.findall(t or "")) for d, t, *_ in rows}
    got = mix_sources(docs, buckets=4).collect()
    assert len(got) == len(rows)
    total = {}
    for r in rows:
        total[r[3]] = total.get(r[3], 0) + size[r[0]]
    names = sorted((s for s in total if s is not None)) + [None]
    weight = {s: (3, 1, 2)[n % 3] for n, s in enumerate(names)}
    goal, clamped = 1.5 * sum(total.values()), set()
    while True:
        level = (goal - sum(2 * total[s] for s in clamped)) / sum(weight[s] for s in names if s not in clamped)
        more = {s for s in names if s not in clamped and weight[s] * level > 2 * total[s]}
        if not more:
            break
        clamped |= more
    taken = {}
    for r in got:
        want = 2 * total[r.source] if r.source in clamped else weight[r.source] * level
        assert r.size == size[r.doc_id] and r.source_size == total[r.source] and abs(r.target - want) < 1e-6 and 0 <= r.taken <= 2 * r.size
        taken.setdefault(r.source, [0, want])[0] += r.taken
    assert all(abs(t - want) <= 0.5 for t, want in taken.values())
    again = mix_sources(docs.repartition(5), buckets=4).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixing_cases(spark, empty, awkward):
    assert mix_sources(empty).count() == 0
    assert [r.taken for r in mix_sources(awkward.where("text is null")).collect()] == [0, 0]
    assert sum(r.taken for r in mix_sources(awkward).collect()) == round(1.5 * sum(len((r.text or "").split()) for r in awkward.collect()))
    sizes = spark.createDataFrame([("b", 10), ("a", 1000), (None, 1000), ("", 3)], "source string, source_size long")
    got = {r.source: r.target for r in targets(sizes, weights=(1, 2), share=1.0).collect()}
    assert got["b"] == 20.0 and abs(sum(got.values()) - 2013) < 1e-6 and got[""] == 6.0


def test_warc(spark, tmp_path):
    ship(spark)
    html = [None, "", "<p>a</p>", "<p>a</p>", "é" * 50_000, "<p>b</p>", "<p>a</p>", "x\r\n\r\nWARC/1.1\r\n"]
    rows = [(n, f"http://x/{n}\r\nX: y", h, 1, "f") for n, h in enumerate(html)] + [(None, None, "<p>b</p>", 1, "f"), (5, "u", "<p>b</p>", 1, "f")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, frame int, bundle string").repartition(2)
    index = warc.write_archives(pages, f"file://{tmp_path}/w", frame_bytes=500)
    got = warc.read_archives(index).collect()
    seen = {(r.page_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in got}
    first = {}
    want = set()
    for page, _, h, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (h or "").encode()
        head = first.setdefault(data, page)
        want.add((page, "response" if head == page else "revisit", len(data), warc.digest(data), None if head == page else head))
    assert len(got) == len(rows) and seen == want
    for r in index.collect():
        fields, block = warc.read_record(r.bundle, r.frame, r.offset)
        assert fields["WARC-Record-ID"] == r.record_id
        if fields["WARC-Type"] == "response":
            assert warc.digest(block.split(b"\r\n\r\n", 1)[1]) == fields["WARC-Payload-Digest"][5:]
    assert warc.read_archives(warc.write_archives(pages.limit(0), f"file://{tmp_path}/e")).count() == 0


def test_secret_scan(spark, docs, empty):
    rng = random.Random(9)
    key = lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
    texts = [f"é aws {key()} and api-key" for _ in range(60)]
    texts += ['Password : "abcdefghijkl" x', "token=short", "PASSWD='aaaaaaaaaaaa' token=tok:secret=abcdefghijklmn", "deadbeefdeadbeef0 AKIAAKIAAKIA", None, "", "secret=" + "0123456789abcdef" * 4]
    texts += ["ASIA" + key()[4:] + " in a sentence of ordinaryconversation" for _ in range(3)]
    frame = spark.createDataFrame([(n, t, None, None, 0, 0, "", "", 0.0) for n, t in enumerate(texts)], ref.SCHEMA)
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r["__secrets"]] for r in secret_scan.find_secrets(frame).collect()}
    import re

    plain = {"assign": secret_scan.ASSIGN, "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}
    for n, t in enumerate(texts):
        want = []
        for kind, pattern in plain.items():
            for m in pattern.finditer(t or ""):
                if (len(m[2]) >= 12) if kind == "assign" else len(m[0]) >= (18 if kind == "access" else 16):
                    want.append((m.start(), list(plain).index(kind), (kind, m.start(), m.end())))
        assert [s for s in got[n] if s[0] != "inferred"] == [w[2] for w in sorted(want)], t
    assert secret_scan.find_secrets(empty).count() == 0
    assert secret_scan.find_secrets(docs).count() == docs.count()


def test_automaton_learns_a_format():
    rng = random.Random(3)
    words = ["ab" * rng.randint(1, 8) for _ in range(300)]
    automaton = automata.learn(words)
    table = automata.logs(automaton)
    assert len(table) <= 4
    assert secret_scan._likelihood(table, "abababababababababababab") > -40
    formats = secret_scan.Formats({"access": ["KEY" + "".join(rng.choice("0123456789") for _ in range(14)) for _ in range(200)]}, ["conversation", "understanding", "extraordinary", "heoratsherin"] * 20)
    assert formats.score("KEY00112233445566") > 0 and formats.score("conversations") < 0


def test_html_field_on_held_out_pages():
    field = html_text.trained_field()
    rng = random.Random(99)
    right = total = 0
    for _ in range(150):
        page, article = html_text.labelled_page(rng)
        total += 1
        right += html_text.main_text(page, field) == "\n".join(article)
    assert right >= 0.9 * total


def test_html_cases(spark):
    ship(spark)
    field = html_text.trained_field()
    assert html_text.main_text(None, field) == "" and html_text.main_text("", field) == "" and html_text.main_text("<", field) in ("", "<")
    page = "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>A &amp; B</h1><p>First\n  line.<br>Next&nbsp;line<p>Second <b>bold</b> one.</article><script>var t='</p>';</script><div class='comments'><p>Nice post!</p></div><footer>&copy; x</footer></body></html>"
    assert html_text.main_text(page, field) == "A & B\nFirst line. Next line\nSecond bold one."
    rows = [(1, "u", page), (1, "u", page), (None, None, None), (2, "v", "<p>" * 5000 + "deep")]
    out = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", html_text.extractor(field)("html")).collect()
    assert [r.text for r in out[:3]] == [html_text.main_text(page, field)] * 2 + [""]


def test_html_elements_left_open():
    """No text behind an element that is left open is lost, and math is text."""
    lines = lambda page: [b.text for b in html_text.leaf_blocks(page)]
    assert lines("<head><title>t</title><p>article") == ["article"]
    assert lines("<html><head><meta charset=u><title>t</title>bare <b>text</b>") == ["bare text"]
    assert lines("<head><template><i>no</i></template><style>p{}</style><body><p>a</p>") == ["a"]
    assert lines("<head><noframes><p>no</p></noframes></head><p>a</p><p>b</p>") == ["a", "b"]
    for tag in ("svg", "select", "object", "canvas", "template"):
        assert lines(f"<article><p>a<{tag}><i>no</i><p>b</p><p>c</p></article><p>d") == ["a", "b", "c", "d"], tag
        assert lines(f"<article><div>a<{tag}>no</div>b<p>c</p></article>") == ["a", "b", "c"], tag
        assert lines(f"<div><span><{tag}>no</span>b</div>") == ["b"], tag
        assert lines(f"<p>a<{tag}>no<{tag}>no</{tag}>no</{tag}>b</p>") == ["a", "b"], tag
        assert lines(f"<p>a<{tag}>no<p>b<{tag}><i>no</i></{tag}>c</p>") == ["a", "b", "c"], tag
        assert lines(f"<p>a<{tag} />b</p>") == ["a", "b"], tag
    for tag in ("select", "object", "canvas", "template"):
        assert lines(f"<div>a<{tag}><script>'<{tag}>'</script><p>no</p></{tag}>b</div>") == ["a", "b"], tag
    assert lines("<p>a<svg><foreignObject><div>no</div></foreignObject></svg>b</p>") == ["a", "b"]
    assert lines("<p>a<script>no<p>no") == ["a"] and lines("<p>a<title>no</title >b") == ["a", "b"]
    assert lines("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>") == ["so x=2 holds."]
    assert lines("<p>so <math><mi>x</mi> holds.</p><p>b") == ["so x holds.", "b"]
    field = html_text.trained_field(100)
    page = "<html><head><title>T</title></head><body><nav><a href='/'>Home</a></nav><article><h1>A</h1><p>First line, said at length.</p><p>Second one, also long.</p></article></body></html>"
    assert html_text.main_text(page.replace("</head><body>", ""), field) == html_text.main_text(page, field) != ""


def test_viterbi_is_the_best_path():
    field = html_text.trained_field(60)
    rng = random.Random(1)
    for _ in range(20):
        blocks = html_text.leaf_blocks(html_text.labelled_page(rng)[0])[:9]
        scores = field.scores(blocks)

        def value(labels):
            total = field.first[labels[0]] + sum(s for s, x in zip(scores, labels) if x)
            return total + sum(field.next[a][b] for a, b in zip(labels, labels[1:]))

        best = max(value([n >> k & 1 for k in range(len(blocks))]) for n in range(1 << len(blocks)))
        assert abs(value(field.decode(blocks)) - best) < 1e-9
