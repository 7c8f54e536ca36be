"""Repetition rules: how much of a text lies in n-grams and lines that it holds more than once."""

from __future__ import annotations

import copy
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitescore.llm.kit import ROLL, U64, Words, mix, rolled

#: Windows of the base count, in words.
BASE_WINDOW = 8
BLANK = " \t\n\r\x0b\x0c"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """Shares above which a text fails, all of the characters inside its words, in percent.

    ``top``: in all places of its most weighty n-gram that comes twice or more.
    ``again``: in n-grams that came before, each character once. ``lines`` is the
    share of lines with a word that equal an earlier line, ``line_chars`` the
    share of the characters of such lines. ``words`` is the least number of words
    and ``base`` the share of words in windows of 8 that come twice or more.
    """

    words: int = 20
    base: int = 30
    top: Mapping[int, int] = field(default_factory=lambda: {2: 20, 3: 20, 4: 20})
    again: Mapping[int, int] = field(default_factory=lambda: dict.fromkeys((5, 6, 7, 8, 9, 10), 20))
    lines: int = 40
    line_chars: int = 25


def word_hashes(words: Words, letters: int = 1 << 20) -> np.ndarray:
    """Hashes of all words, made from about ``letters`` bytes at a time."""
    total = np.cumsum(words.end - words.start)
    if not len(total):
        return np.zeros(0, U64)
    cuts = np.unique(np.append(np.searchsorted(total, np.arange(0, total[-1], letters)), len(total)))
    cuts = np.unique(np.append(0, cuts))
    out = []
    for s, e in zip(cuts[:-1], cuts[1:]):
        part = copy.copy(words)
        part.start, part.end = words.start[s:e], words.end[s:e]
        out.append(part.hashes())
    return np.concatenate(out)


class Grams:
    """The n-grams of several texts, grouped by text and rolling hash.

    ``start`` is where each one begins and ``group`` the place in ``first`` of
    the first one with the same words in the same text. Equal hashes are
    confirmed word by word; if any differ, the groups are made from the words.
    """

    def __init__(self, hashes: np.ndarray, doc: np.ndarray, width: int):
        rolling = rolled(hashes, width)
        self.width = width
        self.start = np.flatnonzero(doc[: len(rolling)] == doc[width - 1 :]) if len(rolling) else np.zeros(0, np.int64)
        salt = mix((doc[self.start].astype(U64) + U64(1)) * ROLL)
        self._group(mix(rolling[self.start] ^ salt))
        held = self.start[self.first[self.group]]
        many = self.size[self.group] > 1
        if not all((hashes[self.start[many] + k] == hashes[held[many] + k]).all() for k in range(width)):
            rows = np.stack([doc[self.start].astype(U64), *[hashes[self.start + k] for k in range(width)]], axis=1)
            self._group(np.unique(rows, axis=0, return_inverse=True)[1].reshape(-1))

    def _group(self, keys: np.ndarray) -> None:
        order = np.argsort(keys)
        run = keys[order]
        fresh = np.ones(len(run), bool)
        fresh[1:] = run[1:] != run[:-1]
        begin = np.flatnonzero(fresh)
        self.size = np.diff(np.append(begin, len(run)))
        self.first = np.minimum.reduceat(order, begin) if len(begin) else begin
        self.group = np.empty(len(run), np.int64)
        self.group[order] = np.cumsum(fresh) - 1

    def covered(self, size: int, later: bool) -> np.ndarray:
        """Which of ``size`` words lie in an n-gram that comes twice or more; with ``later``, not in its first place."""
        some = self.size[self.group] > 1
        if later:
            some[self.first[self.group[some]]] = False
        step = np.zeros(size + 1, np.int32)
        np.add.at(step, self.start[some], 1)
        np.add.at(step, self.start[some] + self.width, -1)
        return np.cumsum(step[:-1]) > 0


def _per_text(values: np.ndarray, words: Words) -> np.ndarray:
    """Sums over the words of each text."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[words.first[1:]] - total[words.first[:-1]]


def line_counts(text: str) -> tuple[int, int, int, int]:
    """Lines with a word, those equal to an earlier one, and the characters of both."""
    held = Counter(line for line in text.split("\n") if line.strip(BLANK))
    again = [(n - 1, len(line)) for line, n in held.items()]
    return (
        sum(held.values()),
        sum(n for n, _ in again),
        sum(n * len(line) for line, n in held.items()),
        sum(n * size for n, size in again),
    )


def measure(texts: list[str], limits: Limits) -> dict[str, np.ndarray]:
    """All counts of several texts, as arrays with a value for each text."""
    words = Words([t.encode() for t in texts])
    n_words = np.diff(words.first)
    # all but the continuation bytes of UTF-8
    points = np.concatenate(([0], np.cumsum((words.data & 0xC0) != 0x80, dtype=np.int64)))
    chars = points[words.end] - points[words.start]
    word_chars = _per_text(chars, words)
    edges = np.cumsum([0] + [len(t.encode()) + 1 for t in texts])
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[words.data], dtype=np.int64)))
    out = {"n_words": n_words, "word_chars": word_chars, "n_symbols": symbols[edges[1:]] - symbols[edges[:-1]]}
    lines = np.array([line_counts(t) for t in texts], np.int64).reshape(len(texts), 4)
    out["n_lines"], out["n_dup_lines"], out["line_chars"], out["dup_line_chars"] = lines.T

    hashes = word_hashes(words)
    before = np.concatenate(([0], np.cumsum(chars)))
    for n in sorted({*limits.top, *limits.again, BASE_WINDOW}):
        grams = Grams(hashes, words.doc, n)
        if n == BASE_WINDOW:
            out["n_repeat_words"] = _per_text(grams.covered(len(chars), False), words)
        if n in limits.again:
            out[f"again_{n}"] = _per_text(chars * grams.covered(len(chars), True), words)
        if n in limits.top:
            many = grams.size > 1
            at = grams.start[grams.first[many]]
            heaviest = np.zeros(len(texts), np.int64)
            np.maximum.at(heaviest, words.doc[at], grams.size[many] * (before[at + n] - before[at]))
            out[f"top_{n}"] = heaviest
    return out


def verdict(found: Mapping[str, np.ndarray], limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) of each text."""
    words, chars = found["n_words"], found["word_chars"]
    failed = (words < limits.words) | (100 * found["n_repeat_words"] > limits.base * words)
    repetitive = (100 * found["n_dup_lines"] > limits.lines * found["n_lines"]) | (100 * found["dup_line_chars"] > limits.line_chars * found["line_chars"])
    for n, most in limits.top.items():
        repetitive |= 100 * found[f"top_{n}"] > most * chars
    for n, most in limits.again.items():
        repetitive |= 100 * found[f"again_{n}"] > most * chars
    return failed, ~(failed | repetitive)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "line_chars", "dup_line_chars", "n_repeat_words")


def pieces(texts: list[str], size: int) -> Iterator[slice]:
    """Slices of whole texts of about ``size`` characters; a longer text is one of its own."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield slice(begin, i)
            begin, held = i, 0
        held += len(text) + 1
    if begin < len(texts):
        yield slice(begin, len(texts))


def measures(limits: Limits = Limits(), piece_chars: int = 1 << 20) -> Column:
    """Column function: text to a struct of all counts, ``base_failed`` and ``kept``."""
    names = [*COUNTS, *[f"top_{n}" for n in limits.top], *[f"again_{n}" for n in limits.again]]
    schema = "struct<" + ",".join(f"{n}:long" for n in names) + ",base_failed:boolean,kept:boolean>"
    kinds = [pa.int64()] * len(names) + [pa.bool_()] * 2
    empty = pa.StructArray.from_arrays([pa.array([], k) for k in kinds], [*names, "base_failed", "kept"])

    def measured(column: pa.Array) -> pa.Array:
        texts = [t or "" for t in column.to_pylist()]
        parts = [empty]
        for piece in pieces(texts, piece_chars):
            found = measure(texts[piece], limits)
            arrays = [pa.array(found[n], pa.int64()) for n in names] + [pa.array(v, pa.bool_()) for v in verdict(found, limits)]
            parts.append(pa.StructArray.from_arrays(arrays, [*names, "base_failed", "kept"]))
        return pa.concat_arrays(parts)

    return F.arrow_udf(measured, schema).asNondeterministic()


def with_repetition(docs: DataFrame, limits: Limits = Limits(), piece_chars: int = 1 << 20) -> DataFrame:
    """``docs`` with a struct column ``__repetition`` of all counts, ``base_failed`` and ``kept``.

    Words lie between ASCII white space; characters are code points. A null or
    empty text has no words, so it fails for its length; a text of fewer words
    than n has no n-grams. Every row is measured by itself, so null ids, ties and
    repeated rows need no rule, and other columns stay as they are. An empty
    table gives an empty one. ``kept`` is false where the base rule fails, else
    it says that no share is above its limit. A text longer than ``piece_chars``
    is measured whole.
    """
    return docs.withColumn("__repetition", measures(limits, piece_chars)(F.col("text")))


def drop_repetitive(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows that are kept, with the columns of ``docs``."""
    return with_repetition(docs, limits).where("__repetition.kept").drop("__repetition")
