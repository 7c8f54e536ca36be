"""Suffix-array dedup: byte strings of a fixed length that exist more than once go.

Every string of ``window`` bytes has an anchor: the place of its smallest hash of
``gram`` bytes. Equal strings have equal anchors at the same offset, so strings
whose anchor's hash exists once are unique. For the others, each anchor with the
text around it (all strings that it anchors) is sent to the other places of the
same hash, and the suffixes of these texts are put in order by linear grouping;
equal strings are then neighbours.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from sitescore.llm.kit import ROLL, U64, chunked, exchange_keys, first_places, mix, read_chunk, rolled
from sitescore.llm.suffix_order import grouped_suffix_order

PLACES = "bin int, key long, chunk int, count int, places binary, around binary"
REPEATS = "chunk int, places binary, repeats binary"
RESULT = "doc_id long, row long, n_bytes long, n_removed long, n_spans long, kept binary"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, valid: np.ndarray, window: int, gram: int, slice_bytes: int = 1 << 21):
    """Runs of strings with one anchor: first start, end of starts, anchor, hash of the anchor."""
    found = []
    for a in range(0, len(data) - window + 1, slice_bytes):
        part = data[a : a + slice_bytes + window - 1]
        hashes = rolled(part.astype(U64) + U64(1), gram)
        bits = U64(len(hashes).bit_length())
        packed = (hashes >> bits << bits) | np.arange(len(hashes), dtype=U64)
        place = (_least(packed, window - gram + 1) & ((U64(1) << bits) - U64(1))).astype(np.int64)
        starts = np.flatnonzero(valid[a : a + len(place)])
        if not len(starts):
            continue
        place = place[starts]
        edge = np.ones(len(starts), bool)
        edge[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(edge)
        last = np.append(first[1:], len(starts)) - 1
        found.append((starts[first] + a, starts[last] + a + 1, place[first] + a, hashes[place[first]]))
    if not found:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),)
    return tuple(np.concatenate(x) for x in zip(*found))


def same_strings(data: np.ndarray, a: np.ndarray, b: np.ndarray, window: int) -> np.ndarray:
    """Whether the strings at a and b are equal, compared eight bytes at a time."""
    eight = np.concatenate((data, np.zeros(8, np.uint8))).astype(U64)
    for shift in (1, 2, 4):
        eight = eight[:-shift] | (eight[shift:] << U64(8 * shift))
    same = np.arange(len(a))
    for at in [*range(0, window - 7, 8), window - 8]:
        same = same[eight[a[same] + at] == eight[b[same] + at]]
    out = np.zeros(len(a), bool)
    out[same] = True
    return out


def _by_order(groups: list[list[bytes]], window: int) -> list[list[np.ndarray]]:
    """For the texts of each group: which starts have an equal string elsewhere in the group."""
    sizes = np.array([len(x) for g in groups for x in g], np.int64)
    joined = np.frombuffer(b"".join(b"\0".join(g) + b"\0\0" for g in groups), np.uint8)
    codes = joined.astype(np.int32) + 2
    texts = np.array([len(g) for g in groups])
    room = sizes + 1
    room[np.cumsum(texts) - 1] += 1
    end = np.cumsum(room)
    begin = end - room
    codes[begin + sizes] = 1
    off = np.concatenate(([0], end[np.cumsum(texts) - 1]))
    codes[off[1:] - 1] = 0
    order = grouped_suffix_order(codes, off)
    good = np.zeros(len(codes) + 1, np.int32)
    good[begin] += 1
    good[begin + sizes - window + 1] -= 1
    good = np.cumsum(good)[:-1] > 0
    x, y = order[:-1], order[1:]
    near = good[x] & good[y]
    near[off[1:-1] - 1] = False
    x, y = x[near], y[near]
    same = same_strings(joined, x, y, window)
    hit = np.zeros(len(codes), bool)
    hit[x[same]] = True
    hit[y[same]] = True
    parts = [hit[s : s + size - window + 1] for s, size in zip(begin, sizes)]
    cut = np.cumsum(texts)
    return [parts[e - k : e] for e, k in zip(cut, texts)]


def _direct(around: list[bytes], anchor_at: list[int], window: int) -> list[np.ndarray]:
    """The same for a very large group: equal strings have the same offset to the anchor, so sort those."""
    hits = [np.zeros(len(x) - window + 1, bool) for x in around]
    by_offset = defaultdict(list)
    for n, (x, at) in enumerate(zip(around, anchor_at)):
        for start in range(len(x) - window + 1):
            by_offset[at - start].append((n, start))
    for places in by_offset.values():
        held = defaultdict(list)
        for n, start in places:
            held[around[n][start : start + window]].append((n, start))
        for equal in held.values():
            if len(equal) > 1:
                for n, start in equal:
                    hits[n][start] = True
    return hits


def _settle(rows: pa.Table, window: int, most: int, batch: int) -> pa.Table:
    """Which starts of each row are repeated."""
    keys, counts = rows["key"].to_pylist(), rows["count"].to_pylist()
    around = rows["around"].to_pylist()
    total: dict[tuple, int] = defaultdict(int)
    groups: dict[int, dict[bytes, None]] = defaultdict(dict)
    for key, text, count in zip(keys, around, counts):
        total[key, text] += count
        groups[key][text] = None
    hits: dict[tuple, np.ndarray | None] = {}
    waiting = []
    for key, texts in groups.items():
        texts = list(texts)
        if len(texts) > most:
            at = [int.from_bytes(x[:4], "little") for x in texts]
            hits.update(((key, x), h) for x, h in zip(texts, _direct([x[4:] for x in texts], at, window)))
        elif len(texts) > 1:
            waiting.append((sum(map(len, texts)), key, texts))
    waiting.sort(key=lambda x: x[0])
    while waiting:
        now, room = [], batch
        while waiting and (room > 0 or not now):
            room -= waiting[-1][0]
            now.append(waiting.pop()[1:])
        for (key, texts), found in zip(now, _by_order([[x[4:] for x in texts] for _, texts in now], window)):
            hits.update(((key, x), h) for x, h in zip(texts, found))
    repeats = []
    for key, text in zip(keys, around):
        hit = hits.get((key, text))
        if total[key, text] > 1:
            hit = np.ones(len(text) - 4 - window + 1, bool)
        repeats.append(hit.astype(np.uint8).tobytes() if hit is not None and hit.any() else None)
    told = pa.array(repeats, pa.binary())
    return pa.table({"chunk": rows["chunk"], "places": rows["places"], "repeats": told}).filter(told.is_valid())


def remove_repeated_bytes(docs: DataFrame, window: int = 200, gram: int = 64, chunk_bytes: int = 8 << 20, hot: int = 256, piece: int = 16, most: int = 256, batch: int = 1 << 21) -> DataFrame:
    """One row per document: doc_id, row, n_bytes, n_removed, n_spans, kept.

    Texts are taken as UTF-8 bytes, null as empty. Every byte goes that a string
    of ``window`` bytes covers which also starts anywhere else, in the same text
    or another one; strings are judged on the input. ``n_spans`` counts the
    maximal removed runs, ``kept`` is what is left. Ids play no part, so null or
    repeated ids are rows like others.

    An anchor that exists ``hot`` times or more is split: the strings around it
    go, ``piece`` offsets at a time, by the hash of all bytes they share. A
    group with more than ``most`` different texts is settled by sorting its
    strings offset by offset instead of ordering all suffixes.
    """
    chunks = chunked(docs, chunk_bytes)
    bins = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def keys_of(rows: pa.Table):
        _, _, texts = read_chunk(rows)
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        end = np.cumsum(sizes)
        valid = np.zeros(len(data) + 1, np.int32)
        full = sizes >= window
        valid[(end - sizes)[full]] += 1
        valid[(end - window + 1)[full]] -= 1
        valid = np.cumsum(valid)[:-1] > 0
        runs = anchors(data, valid, window, gram)
        first, counts = first_places(runs[3])
        return runs[3][first], counts, (rows["chunk"][0].as_py(), data, end - sizes, runs, first)

    def finish(state, flags: np.ndarray) -> pa.Table:
        chunk, data, begin, (first, last, anchor, hashes), place = state
        keys = hashes[place]
        order = np.argsort(keys)
        flag = flags[order[np.searchsorted(keys[order], hashes)]] if len(keys) else np.zeros(0, np.uint8)
        some = np.flatnonzero(flag)
        doc = np.searchsorted(begin, first[some], "right") - 1
        raw = data.tobytes()
        held: dict[tuple[int, bytes], list] = defaultdict(list)
        for s, e, a, key, level, d, b in zip(first[some].tolist(), last[some].tolist(), anchor[some].tolist(), hashes[some].tolist(), flag[some].tolist(), doc.tolist(), begin[doc].tolist()):
            if level == 1:
                held[key, (a - s).to_bytes(4, "little") + raw[s : e - 1 + window]].append((d, s - b))
                continue
            while s < e:
                part = (a - s) // piece
                stop = min(e, a - part * piece + 1)
                shared = raw[a - part * piece : a - part * piece - piece + 1 + window]
                own = xxhash.xxh3_64_intdigest(shared, seed=(key + part) & (2**64 - 1))
                held[own, (a - s).to_bytes(4, "little") + raw[s : stop - 1 + window]].append((d, s - b))
                s = stop
        all_keys = np.fromiter((k for k, _ in held), U64, len(held))
        return pa.table(
            {
                "bin": pa.array((mix(all_keys ^ ROLL) % U64(bins)).astype(np.int32)),
                "key": pa.array(all_keys.view(np.int64)),
                "chunk": pa.array([chunk] * len(held), pa.int32()),
                "count": pa.array([min(2, len(x)) for x in held.values()], pa.int32()),
                "places": pa.array([np.array(x, np.int32).tobytes() for x in held.values()], pa.binary()),
                "around": pa.array([x for _, x in held], pa.binary()),
            }
        )

    def settle(rows: pa.Table) -> pa.Table:
        return _settle(rows, window, most, batch)

    def cut(rows: pa.Table, told: pa.Table) -> pa.Table:
        ids, keys, texts = read_chunk(rows) if rows.num_rows else ([], [], [])
        sizes = np.array([len(t) for t in texts], np.int64)
        begin = np.concatenate(([0], np.cumsum(sizes + 1)))
        cover = np.zeros(int(begin[-1]) + window + 1, np.int32)
        for places, repeats in zip(told["places"].to_pylist(), told["repeats"].to_pylist()):
            hit = np.flatnonzero(np.frombuffer(repeats, np.uint8))
            edge = np.flatnonzero(np.diff(hit, prepend=-2, append=hit[-1] + 2) > 1)
            runs = [(int(hit[x]), int(hit[y - 1])) for x, y in zip(edge[:-1], edge[1:])]
            for d, s in np.frombuffer(places, np.int32).reshape(-1, 2).tolist():
                for x, y in runs:
                    cover[begin[d] + s + x] += 1
                    cover[begin[d] + s + y + window] -= 1
        gone = np.cumsum(cover) > 0
        n_removed, n_spans, left = [], [], []
        for d, text in enumerate(texts):
            mine = gone[begin[d] : begin[d] + len(text)]
            removed = int(mine.sum())
            n_removed.append(removed)
            n_spans.append(int((mine[1:] & ~mine[:-1]).sum() + mine[0]) if removed else 0)
            left.append(np.frombuffer(text, np.uint8)[~mine].tobytes() if removed else text)
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "row": pa.array(keys, pa.int64()),
                "n_bytes": pa.array(sizes, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "n_spans": pa.array(n_spans, pa.int64()),
                "kept": pa.array(left, pa.binary()),
            }
        )

    around = exchange_keys(chunks, keys_of, finish, PLACES, hot=hot)
    told = around.groupBy("bin").applyInArrow(settle, REPEATS)
    return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(cut, RESULT)
