"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1; an n-gram's vector binds (by
multiplication) its letters' vectors, each permuted (rolled) by its place; a
text's vector bundles (adds) those of all its n-grams. A language's prototype is
the bundle of all its learning texts, and a text goes to the prototype with the
largest cosine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters are told apart modulo this: 0 is any non-letter, then a to z, then the others by code point.
SYMBOLS = 64
UNKNOWN = "und"

_TABLE: np.ndarray | None = None


def _symbols(text: str) -> np.ndarray:
    """Symbol of each letter, runs of other characters as one 0, with 0 at both ends."""
    global _TABLE
    if _TABLE is None:
        codes = range(0x110000)
        _TABLE = np.fromiter((0 if not chr(c).isalpha() else c - 96 if 97 <= c <= 122 else 27 + c % (SYMBOLS - 27) for c in codes), np.uint8, 0x110000)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.zeros(len(codes) + 2, np.uint8)
    found[1:-1] = _TABLE[codes]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != 0) | (found[:-1] != 0)
    return found[keep]


def _grams(text: str) -> np.ndarray:
    s = _symbols(text).astype(np.int32)
    return (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:] if len(s) > 2 else np.zeros(0, np.int32)


class Space:
    """Vectors of all letter trigrams, made when first met (at most SYMBOLS ** 3)."""

    def __init__(self, dims: int, seed: int):
        letters = np.random.default_rng(seed).integers(0, 2, (SYMBOLS, dims), np.int8) * 2 - 1
        self.dims = dims
        self.rolled = [np.roll(letters, 2, 1), np.roll(letters, 1, 1), letters]
        self.row = np.full(SYMBOLS**3, -1, np.int32)
        self.made = np.zeros((0, dims), np.int8)
        self.used = 0

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        new = grams[self.row[grams] < 0]
        if len(new):
            if self.used + len(new) > len(self.made):
                self.made = np.concatenate((self.made, np.zeros((max(2048, len(self.made), len(new)), self.dims), np.int8)))
            a, b, c = new // SYMBOLS**2, new // SYMBOLS % SYMBOLS, new % SYMBOLS
            self.made[self.used : self.used + len(new)] = self.rolled[0][a] * self.rolled[1][b] * self.rolled[2][c]
            self.row[new] = np.arange(self.used, self.used + len(new))
            self.used += len(new)
        return self.made[self.row[grams]]

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.zeros(self.dims, np.float32)
        for i in range(0, len(grams), 1024):
            total += counts[i : i + 1024].astype(np.float32) @ self.vectors(grams[i : i + 1024]).astype(np.float32)
        return total


def _space(dims: int, seed: int, known: dict = {}) -> Space:  # noqa: B006  one for each worker
    return known.setdefault((dims, seed), Space(dims, seed))


def learn(docs: DataFrame, dims: int = 1024, seed: int = 7) -> dict[str, list[float]]:
    """Prototype of each language, from all rows of (lang, text) with neither null.

    Texts are bundled where they are read; only sums by (lang, dimension) are
    shuffled, and one vector for each language reaches the driver.
    """

    def bundles(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in rows:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                held = counts.setdefault(lang, np.zeros(SYMBOLS**3, np.int64))
                grams, n = np.unique(_grams(text), return_counts=True)
                held[grams] += n
        space = _space(dims, seed)
        for lang, held in counts.items():
            grams = np.flatnonzero(held)
            total = np.zeros(dims, np.int64)
            for i in range(0, len(grams), 512):
                total += held[grams[i : i + 512]] @ space.vectors(grams[i : i + 512]).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * dims, "dim": pa.array(range(dims), pa.int32()), "value": pa.array(total, pa.int64())})

    rows = docs.select(F.col("lang").cast("string").alias("lang"), "text").where("lang is not null and text is not null")
    sums = rows.mapInArrow(bundles, "lang string, dim int, value long").groupBy("lang", "dim").agg(F.sum("value").alias("value"))
    prototypes: dict[str, list[float]] = {}
    for lang, dim, value in sums.collect():
        prototypes.setdefault(lang, [0.0] * dims)[dim] = float(value)
    return {k: prototypes[k] for k in sorted(prototypes)}


def predictor(prototypes: dict[str, list[float]], seed: int = 7) -> Callable[[Column], Column]:
    """Column function: text to struct(lang_pred, score).

    A null text, one without letters, or any text if nothing was learned gives
    (und, 0). Ties go to the language that sorts first; score is the cosine, not
    under 0.
    """
    names = list(prototypes)
    dims = len(next(iter(prototypes.values()))) if names else 1
    matrix = np.array([prototypes[n] for n in names], np.float64).reshape(len(names), dims)
    size = np.sqrt((matrix**2).sum(1, keepdims=True))
    matrix = np.divide(matrix, size, out=np.zeros_like(matrix), where=size > 0).astype(np.float32)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        space = _space(dims, seed)
        langs, scores = [], []
        for text in texts.to_pylist():
            grams, counts = np.unique(_grams(text), return_counts=True) if text and names else (np.zeros(0, int), None)
            lang, score = UNKNOWN, 0.0
            if len(grams):
                vector = space.bundle(grams, counts)
                norm = float(np.sqrt(vector @ vector))
                cosines = matrix @ vector / norm if norm else np.zeros(len(names))
                best = int(np.argmax(cosines))
                lang, score = names[best], min(1.0, max(0.0, float(cosines[best])))
            langs.append(lang)
            scores.append(score)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return predict.asNondeterministic()


def has_letters(text: Column) -> Column:
    """Whether a text has a letter, whatever was learned; null has none."""

    def letters(texts: pa.Array) -> pa.Array:
        return pa.array([t is not None and any(map(str.isalpha, t)) for t in texts.to_pylist()], pa.bool_())

    return F.arrow_udf(letters, "boolean").asNondeterministic()(text)


def held_out(doc_id: str = "doc_id") -> Column:
    """Every fifth document by the CRC-32 of its id; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def identify(docs: DataFrame, dims: int = 1024, seed: int = 7) -> DataFrame:
    """``docs`` with a struct column ``__language``, learned from all rows that are not held out."""
    prototypes = learn(docs.where(~held_out()), dims, seed)
    return docs.withColumn("__language", predictor(prototypes, seed)(F.col("text")))
