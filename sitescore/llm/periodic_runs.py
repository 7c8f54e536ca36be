"""Periodic runs of words by string synchronising sets.

At each scale t, a power of two, a set of positions is chosen by the smallest
hash of the windows of t words around them, so that equal surroundings choose
equal places and every stretch of t places has one, unless 3t words there repeat
with a period of t/3 or less. Two neighbouring chosen places with equal contexts
propose their distance as a period from 2t to 4t. Periods of up to 7 words are
found apart by comparing shifted texts; these and the runs of smaller scales are
the regions where no place is chosen. Each proposal is settled on the words.

A context of 3t words serves periods up to 3t, one of 4t words those up to 4t: a
run of three periods p has a chosen place with room for p and a context behind
it, and a context no shorter than p cannot recur within the run sooner than p.
"""

from __future__ import annotations

from functools import reduce
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitescore.llm.kit import MIX1, ROLL, U64, mix

#: Largest period found by comparing shifted texts.
SMALL = 7
NEVER = U64(2**64 - 1)


def _stretches(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def small_runs(text: np.ndarray, most: int = SMALL) -> list[tuple[int, int, int]]:
    """(start, end, period) of all maximal repetitions of three periods or more with periods up to ``most``."""
    found: dict[tuple[int, int], int] = {}
    for p in range(1, min(most, len(text) // 3) + 1):
        starts, ends = _stretches(text[:-p] == text[p:])
        long = ends - starts >= 2 * p
        for s, e in zip(starts[long].tolist(), ends[long].tolist()):
            # what has a smaller period too was found with it
            found.setdefault((s, e + p), p)
    return [(s, e, p) for (s, e), p in found.items()]


def pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * MIX1 + (right ^ ROLL))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def synchronising_set(windows: np.ndarray, scale: int, periodic: list[tuple[int, int]]) -> np.ndarray:
    """Places i whose or whose i + scale's window has the smallest hash of all from i to i + scale.

    ``windows`` are the hashes of all windows of ``scale`` words; those that begin
    inside ``periodic`` (first, last) are left out.
    """
    ranked = np.minimum(windows, NEVER - U64(1))
    for first, last in periodic:
        ranked[first : last + 1] = NEVER
    if len(ranked) <= scale:
        return np.zeros(0, np.int64)
    least = sliding_min(ranked, scale + 1)
    return np.flatnonzero((least != NEVER) & ((ranked[: len(least)] == least) | (ranked[scale:] == least)))


def _equal_for(text: np.ndarray, a: int, b: int, forward: bool) -> int:
    """For how many places text[a...] equals text[b...], b > a; backward from a - 1 and b - 1."""
    done, step = 0, 64
    while True:
        if forward:
            x, y = text[a + done : a + done + step], text[b + done : b + done + step]
            x = x[: len(y)]
        else:
            x, y = text[max(0, a - done - step) : a - done][::-1], text[max(0, b - done - step) : b - done][::-1]
            y = y[: len(x)]
        differ = np.flatnonzero(x != y)
        if len(differ):
            return done + int(differ[0])
        done += len(x)
        if len(x) < step:
            return done
        step *= 2


def _settle(text: np.ndarray, places: np.ndarray, distances: np.ndarray, found: dict[tuple[int, int], int]) -> None:
    """Add the maximal repetitions of three periods or more around proposed (place, period) pairs."""
    order = np.lexsort((places, distances))
    reach, period = -1, 0
    for i, d in zip(places[order].tolist(), distances[order].tolist()):
        # the next places of a run lie inside it, a whole period before its end
        if d == period and i + d < reach:
            continue
        s = i - _equal_for(text, i, i + d, False)
        e = i + d + _equal_for(text, i, i + d, True)
        reach, period = e, d
        if e - s >= 3 * d:
            found[s, e] = min(d, found.get((s, e), d))


def repetitions(text: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, end, smallest period) of all maximal repetitions of three periods or more in ``text``.

    ``text`` holds numbers; several texts may stand in it, parted by numbers that
    come once, with ``longest`` the length of the longest.
    """
    longest = len(text) if longest is None else longest
    found = {(s, e): p for s, e, p in small_runs(text)}
    windows = mix((text.astype(U64) + U64(1)) * ROLL)
    scale, built = (SMALL + 1) // 2, 1
    while 6 * scale <= longest:
        while built < scale:
            windows = pair_hashes(windows[:-built], windows[built:])
            built *= 2
        doubled = pair_hashes(windows[:-scale], windows[scale:])
        regions = [(s, e - scale) for (s, e), p in found.items() if 3 * p <= scale <= e - s]
        chosen = synchronising_set(windows, scale, regions)
        triple = lambda at: pair_hashes(doubled[at], windows[at + 2 * scale])
        quadruple = lambda at: pair_hashes(doubled[at], doubled[at + 2 * scale])
        for times, context in ((3, triple), (4, quadruple)):
            places = chosen[chosen + times * scale <= len(text)]
            names = context(places)
            order = np.argsort(names, kind="stable")
            first, second = places[order[:-1]], places[order[1:]]
            apart = second - first
            equal = (names[order[1:]] == names[order[:-1]]) & (apart >= (times - 1) * scale) & (apart <= times * scale)
            _settle(text, first[equal], apart[equal], found)
        scale *= 2
    return [(s, e, p) for (s, e), p in found.items()]


def runs_of(texts: list[bytes], least: int, power: int) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """For each text its number of words, runs (start, length, period) by start and period, and the words kept.

    The texts are searched end to end, parted by numbers of their own.
    """
    tokens = [t.split() for t in texts]
    sizes = np.array([len(t) for t in tokens], np.int64)
    names = pa.array([w for t in tokens for w in t], pa.binary()).dictionary_encode()
    words = np.full(int(sizes.sum()) + len(texts), -1, np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])).astype(np.int64)
    parting = begin + sizes
    inside = np.ones(len(words), bool)
    inside[parting] = False
    words[inside] = names.indices.to_numpy()
    words[parting] = len(names.dictionary) + np.arange(len(texts))

    held: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for s, e, p in repetitions(words, int(sizes.max(initial=0))):
        if e - s >= max(least, power * p):
            d = int(np.searchsorted(begin, s, side="right")) - 1
            held[d].append((s - int(begin[d]), e - s, p))
    out = []
    for mine, runs in zip(tokens, held):
        runs.sort(key=lambda r: (r[0], r[2]))
        kept = mine
        if runs:
            stays = np.ones(len(mine), bool)
            for s, n, p in runs:
                stays[s + p : s + n] = False
            kept = compress(mine, stays.tolist())
        out.append((len(mine), runs, b" ".join(kept)))
    return out


def _stronger(a: tuple[int, int, int], b: tuple[int, int, int]) -> tuple[int, int, int]:
    """The run with more length for its period, exactly; ties: smaller start, then period."""
    x, y = a[1] * b[2], b[1] * a[2]
    return a if x > y or (x == y and (a[0], a[2]) <= (b[0], b[2])) else b


RUN = "struct<start:long,length:long,period:long>"


def runs_in(least: int = 24, power: int = 3, piece_chars: int = 1 << 20) -> Column:
    """Column function: text to struct(n_words, runs, strongest, collapsed)."""
    if power < 3:
        raise ValueError("runs of less than three periods are not searched for")
    run_type = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    kinds = {"n_words": pa.int64(), "runs": pa.list_(run_type), "strongest": run_type, "collapsed": pa.string()}

    def structs(runs: list[tuple[int, int, int]]) -> list[dict[str, int]]:
        return [dict(zip(("start", "length", "period"), r)) for r in runs]

    def found_in(texts: list[str]) -> pa.StructArray:
        rows = runs_of([t.encode() for t in texts], least, power)
        strongest = [structs([reduce(_stronger, r)])[0] if r else None for _, r, _ in rows]
        columns = [[n for n, _, _ in rows], [structs(r) for _, r, _ in rows], strongest]
        arrays = [pa.array(c, k) for c, k in zip(columns, list(kinds.values())[:3])]
        arrays.append(pa.array([c for _, _, c in rows], pa.binary()).cast(pa.string()))
        return pa.StructArray.from_arrays(arrays, list(kinds))

    def searched(column: pa.Array) -> pa.Array:
        # short texts go together, so that large scales are only built for long ones
        sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(sizes, kind="stable")
        held = np.cumsum(sizes[order] + 1)
        parts, begin = [found_in([])], 0
        while begin < len(order):
            # texts of about ``piece_chars`` bytes, one at least; only these are Python objects at a time
            end = max(begin + 1, int(np.searchsorted(held, (held[begin - 1] if begin else 0) + piece_chars, side="right")))
            parts.append(found_in([t or "" for t in column.take(pa.array(order[begin:end])).to_pylist()]))
            begin = end
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        out = pa.concat_arrays(parts)
        del parts
        return out.take(pa.array(back))

    schema = f"struct<n_words:long,runs:array<{RUN}>,strongest:{RUN},collapsed:string>"
    return F.arrow_udf(searched, schema).asNondeterministic()


def find_runs(docs: DataFrame, least: int = 24, power: int = 3, piece_chars: int = 1 << 20) -> DataFrame:
    """``docs`` with a struct column ``__runs``: n_words, runs, strongest, collapsed.

    A run is a stretch of words, parted by ASCII white space, with smallest period
    q (words q apart are the same) and a length of ``least`` and ``power`` * q at
    least (``power`` is 3 or more), that cannot grow to either side. ``runs`` are
    (start, length, period), counted in words from 0, by start and then period;
    ``strongest`` has the most length for its period, ties by start, then period,
    and is null if there is no run. ``collapsed`` holds the words, joined by one
    space, without those that a run holds after its first q. Null and empty texts
    have no words and no runs. Each row stands for itself: null or repeated ids
    and repeated rows change nothing, and other columns stay. Long texts are
    searched whole; the work grows with n log n.
    """
    return docs.withColumn("__runs", runs_in(least, power, piece_chars)(F.col("text")))


def collapse_runs(docs: DataFrame, least: int = 24, power: int = 3) -> DataFrame:
    """``docs`` with the collapsed text in place of texts that hold a run; the others stay as they are."""
    found = find_runs(docs, least, power)
    text = F.when(F.size("__runs.runs") > 0, F.col("__runs.collapsed")).otherwise(F.col("text"))
    return found.withColumn("text", text).drop("__runs")


def periodic_end(words: list[bytes], h: int) -> list[bytes]:
    """``words`` with an end made periodic: its place, period and length follow from the number ``h``."""
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def planted(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text of one document in ten, by the CRC-32 of its id, with a periodic end; else the text as it is.

    Null ids and texts without words stay. A plain function on the words: Spark
    does not hand an argument that holds a lambda to the search that follows.
    """

    def changed(hashes: pa.Array, texts: pa.Array) -> pa.Array:
        parts = [pa.array([], pa.string())]
        for begin in range(0, len(texts), 500):
            out = []
            for h, t in zip(hashes.slice(begin, 500).to_pylist(), texts.slice(begin, 500).to_pylist()):
                words = t.encode().split() if h is not None and h % 10 == 0 and t is not None else []
                out.append(b" ".join(periodic_end(words, h)).decode() if words else t)
            parts.append(pa.array(out, pa.string()))
        return pa.concat_arrays(parts)

    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.arrow_udf(changed, "string").asNondeterministic()(h, F.col(text))
