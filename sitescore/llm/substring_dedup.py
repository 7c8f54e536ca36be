"""Substring dedup by Rabin-Karp hashes of every window of words."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sitescore.llm.kit import NO_ID, Words, chunked, exchange_keys, first_places, read_chunk, rolled

RESULT = "doc_id long, row long, n_words long, n_removed long, kept string, starts array<int>, ends array<int>"


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def remove_repeats(docs: DataFrame, window: int = 20, chunk_bytes: int = 8 << 20) -> DataFrame:
    """One row per document: doc_id, row, n_words, n_removed, kept, starts, ends.

    Words lie between ASCII white space. A window of ``window`` words is a
    repeat if its words also start earlier: in a document with a smaller id, or
    further up in the same one. All words that a repeat covers go; the maximal
    runs of such words are ``starts`` to ``ends``; ``kept`` joins the others by
    one space. Null texts have no words, null ids come before all others, and of
    rows with the same id the one with the smaller chunk, then row key, is the
    earlier. Windows compare by hashes of 64 bits and the bucket.

    Each chunk of documents sends every different window once, so a passage that
    very many documents share weighs no more than one window for each chunk.
    """

    def windows(rows: pa.Table):
        ids, keys, texts = read_chunk(rows)
        words = Words(texts)
        hashes = rolled(words.hashes(), window)
        starts = np.flatnonzero(words.doc[: len(hashes)] == words.doc[window - 1 :]) if len(hashes) else np.zeros(0, int)
        hashes = hashes[starts]
        first, _ = first_places(hashes)
        order = np.array([NO_ID if i is None else i for i in ids], np.int64)
        return hashes[first], order[words.doc[starts[first]]], (ids, keys, texts, words, starts, first)

    def finish(state, later: np.ndarray) -> pa.Table:
        ids, keys, texts, words, starts, first = state
        repeat = np.ones(len(starts), bool)
        repeat[first] = later > 0
        cover = np.zeros(len(words.start) + 1, np.int32)
        cover[starts[repeat]] += 1
        cover[starts[repeat] + window] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        n_words, n_removed, kept, begins, ends = [], [], [], [], []
        for d, text in enumerate(texts):
            mine = gone[words.first[d] : words.first[d + 1]]
            tokens = text.split()
            removed = int(mine.sum())
            s, e = _runs(mine) if removed else ((), ())
            n_words.append(len(mine))
            n_removed.append(removed)
            kept.append(b" ".join(compress(tokens, (~mine).tolist()) if removed else tokens))
            begins.append(s)
            ends.append(e)
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "row": pa.array(keys, pa.int64()),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                "starts": pa.array(begins, pa.list_(pa.int32())),
                "ends": pa.array(ends, pa.list_(pa.int32())),
            }
        )

    return exchange_keys(chunked(docs, chunk_bytes), windows, finish, RESULT)
