"""Brute-force forms of the text operators, and rows with every awkward case."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk int, row string, name string, kind double"


def lowered(text: str | None) -> str:
    return (text or "").encode().lower().decode()


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def documents(seed: int = 0, size: int = 120) -> list[tuple]:
    """Rows with copies, near copies, shared passages, nulls, empty and long texts, and clashing columns."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéÄöñß") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = words(60)
    texts: list[str | None] = [None, "", " \t\n ", "one", "One", "two words", "two  words", "...", "漢字 かな", "a b c", "A b C", "x" * 900, "ab" * 700]
    texts += [" ".join(words(3000)), "na " * 500, "na " * 400]
    for _ in range(size):
        base = words(rng.randint(1, 90))
        kind = rng.random()
        if kind < 0.2:
            at = rng.randint(0, len(base))
            base[at:at] = passage[rng.randint(0, 10) : rng.randint(35, 60)]
        texts.append(rng.choice([" ", " ", "\n"]).join(base))
        if kind > 0.6:
            again = list(base)
            for _ in range(rng.randint(0, 2)):
                again[rng.randrange(len(again))] = rng.choice(vocabulary)
            texts.append(" ".join(again))
        if kind > 0.9:
            texts.append(texts[-1].upper() if rng.random() < 0.5 else texts[-1])
    return [(n, t, rng.choice(["en", "fr", None]), rng.choice(["s0", "s0", "s1", None, ""]), 0, 1, "r", "n", 0.5) for n, t in enumerate(texts)]


def substring(rows: list[tuple], window: int) -> dict:
    seen, out = {}, {}
    for d, text, *_ in sorted(rows, key=lambda r: r[0]):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if seen.setdefault(tuple(words[k : k + window]), (d, k)) != (d, k):
                gone[k : k + window] = [True] * window
        out[d] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return out


def repeated_bytes(rows: list[tuple], window: int) -> dict:
    count = Counter()
    data = {d: (text or "").encode() for d, text, *_ in rows}
    for b in data.values():
        count.update(b[k : k + window] for k in range(len(b) - window + 1))
    out = {}
    for d, b in data.items():
        gone = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if count[b[k : k + window]] > 1:
                gone[k : k + window] = b"\1" * window
        out[d] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(x for x, g in zip(b, gone) if not g))
    return out


def near(rows: list[tuple], width: int, percent: int) -> dict:
    sets = {}
    for d, text, *_ in rows:
        words = WORD.findall(lowered(text))
        sets[d] = frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1)) if len(words) >= width else frozenset([tuple(words)] if words else [])
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def benchmark_words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def leaks(rows: list[tuple], items: list[tuple], window: int) -> dict:
    patterns = defaultdict(set)
    for item, text in items:
        words = benchmark_words(text)
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            patterns[tuple(words[k : k + n])].add(str(item))
    out = {}
    for d, text, *_ in rows:
        words, hit, found = benchmark_words(text), set(), set()
        for n in {len(p) for p in patterns}:
            for k in range(len(words) - n + 1):
                names = patterns.get(tuple(words[k : k + n]))
                if names:
                    hit.update(range(k, k + n))
                    found |= names
        out[d] = (len(words), len(hit), sorted(found))
    return out
