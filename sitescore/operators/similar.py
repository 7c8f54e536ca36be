"""Join of texts that differ by a few edits, by shared segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitescore.operators.balance import balanced_join

SEGMENT = ("__size", "__part", "__piece")


def _begin(size: str, part: str, parts: int) -> str:
    """Where a segment begins, from 0: the last ones of a text are a letter longer if it does not divide evenly."""
    return f"({part} * ({size} div {parts}) + greatest(0, {part} - ({parts} - {size} % {parts})))"


def _width(size: str, part: str, parts: int) -> str:
    return f"({size} div {parts} + CASE WHEN {part} >= {parts} - {size} % {parts} THEN 1 ELSE 0 END)"


def segments(text: str, edits: int) -> Column:
    """``edits`` + 1 segments of a text, as (__size of the text, __part, __piece)."""
    k, size = edits + 1, f"char_length({text})"
    piece = f"substring({text}, CAST({_begin(size, 'i', k)} + 1 AS INT), CAST({_width(size, 'i', k)} AS INT))"
    return F.expr(f"transform(sequence(0, {edits}), i -> named_struct('__size', {size}, '__part', i, '__piece', {piece}))")


def probes(text: str, edits: int) -> Column:
    """The pieces of a text that a segment of a text at most ``edits`` edits away must be one of.

    A segment with i segments before it is shifted by i letters at most, seen from
    the left, and by ``edits`` - i from the right, seen with the difference of the
    lengths; only places within both bounds are asked for.
    """
    k, size = edits + 1, f"char_length({text})"
    first, wide = _begin("s", "i", k), _width("s", "i", k)
    low = f"greatest(0, {first} - i, {first} + ({size} - s) - ({edits} - i))"
    high = f"least({size} - {wide}, {first} + i, {first} + ({size} - s) + ({edits} - i))"
    piece = f"substring({text}, CAST(p + 1 AS INT), CAST({wide} AS INT))"
    places = f"CASE WHEN {low} <= {high} THEN sequence(CAST({low} AS INT), CAST({high} AS INT)) ELSE array() END"
    asked = f"transform({places}, p -> named_struct('__size', s, '__part', i, '__piece', {piece}))"
    sizes = f"sequence(greatest({size} - {edits}, 0), {size} + {edits})"
    return F.expr(f"array_distinct(flatten(transform({sizes}, s -> flatten(transform(sequence(0, {edits}), i -> {asked})))))")


def similar_pairs(left: DataFrame, right: DataFrame, on: Sequence[str], left_text: str, right_text: str, edits: int) -> DataFrame:
    """Pairs of rows that agree in ``on`` and whose texts are at most ``edits`` edits apart, with ``__edits``.

    Of two such texts one cut into ``edits`` + 1 segments keeps at least one of
    them whole in the other, near its place; so the right texts give ``edits`` + 1
    rows each and meet the pieces of the left ones in an equi join, with frequent
    segments split. The exact distance decides. A pair comes once for every
    segment it shares. NULL texts and keys pair with nothing; columns other than
    ``on`` must differ between the sides.
    """
    keys = [*on, *SEGMENT]
    cut = right.where(F.col(right_text).isNotNull()).select("*", F.inline(segments(right_text, edits)))
    asked = left.where(F.col(left_text).isNotNull()).select("*", F.inline(probes(left_text, edits)))
    met = balanced_join(asked, cut, keys, left_by=[*on, left_text], right_by=[*on, right_text]).drop(*SEGMENT)
    return met.withColumn("__edits", F.levenshtein(left_text, right_text, edits)).where(F.col("__edits") >= 0)
