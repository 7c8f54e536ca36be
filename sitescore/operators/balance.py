"""Equi joins that stay even when a few keys hold most of the rows.

A key whose work (pairs to build, or rows to carry) exceeds 1/1024 of the total
is hot; at most 1024 keys can be, so their list has a fixed size bound. Without
hot keys the join is a plain one. Otherwise:

- If the right side has few rows for the hot keys (counted first), these rows
  are broadcast: hot left rows are joined where they lie and only the others
  are shuffled.
- Else hot keys are split: the rows of a key's larger side get one of n salts by
  hash, the rows of its other side are repeated for every salt, and the join
  runs on (key, salt). The salt is a hash of the row, so a recomputed task gives
  the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECES = 1024
MIN_WORK = 4_000_000
MAX_BROADCAST_ROWS = 16 * PIECES
SALT = "__salt"
FIND = "find"


def hot_keys(
    left: DataFrame,
    right: DataFrame | None,
    on: Sequence[str],
    min_work: int = MIN_WORK,
) -> DataFrame | None:
    """Keys to split: (keys, ``__splits``, ``__split_left``), at most ``PIECES`` rows.

    Without ``right`` the work of a key is its number of left rows; with it, the
    number of pairs. None if no key is hot. Runs a count per key, which is
    combined before the shuffle.
    """
    work = left.groupBy(*on).agg(F.count(F.lit(1)).cast("double").alias("__work"), F.lit(True).alias("__split_left"))
    if right is not None:
        counts = right.groupBy(*on).agg(F.count(F.lit(1)).cast("double").alias("__right"))
        work = work.join(counts, on=list(on)).select(
            *on,
            (F.col("__work") * F.col("__right")).alias("__work"),
            (F.col("__work") >= F.col("__right")).alias("__split_left"),
        )
    total, largest = work.agg(F.sum("__work"), F.max("__work")).first()
    if largest is None or largest <= min_work:
        return None
    piece = max(total / PIECES, float(min_work))
    hot = work.where(F.col("__work") > piece).select(
        *on, F.ceil(F.col("__work") / piece).cast("int").alias("__splits"), "__split_left"
    )
    # Fixed bound: each row stands for more than 1/PIECES of the total.
    rows = hot.collect()
    return left.sparkSession.createDataFrame(rows, hot.schema) if rows else None


def _match(df: DataFrame, on: Sequence[str], hot: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``hot`` with its keys renamed, and the condition that equates them; NULL equals NULL."""
    marked = F.broadcast(hot.select(*[F.col(k).alias(f"__hot_{k}") for k in on], "__splits", "__split_left"))
    return marked, [df[k].eqNullSafe(marked[f"__hot_{k}"]) for k in on]


def _salted(df: DataFrame, on: Sequence[str], hot: DataFrame, salt: Column) -> DataFrame:
    """``df`` with a salt computed from the columns of ``hot``, NULL for other keys."""
    joined = df.join(*_match(df, on, hot), "left")
    return joined.select(*[df[c] for c in df.columns], salt.alias(SALT))


def _own_salt(df: DataFrame, by: Sequence[str] | None) -> Column:
    return F.pmod(F.xxhash64(*[df[c] for c in (by or df.columns)]), F.col("__splits").cast("bigint")).cast("int")


def _every_salt() -> Column:
    return F.sequence(F.lit(0), F.col("__splits") - 1)


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    right_unique: bool = False,
    distinct_left: bool = False,
    min_work: int = MIN_WORK,
    left_by: Sequence[str] | None = None,
    right_by: Sequence[str] | None = None,
    hot: DataFrame | str | None = FIND,
) -> DataFrame:
    """Inner or left join on equal keys with hot keys split.

    ``right_unique`` says that the right side has one row per key, so only left
    rows need splitting (a left join splits left rows in any case).
    ``distinct_left`` removes duplicate left rows on the join's own
    partitioning, without a shuffle of its own. ``left_by``/``right_by`` name
    the columns whose hash spreads a side; default all of them. ``hot`` passes
    on what ``hot_keys`` found before, so that several joins of the same rows
    count them once; which keys are split never changes the result.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    on = [on] if isinstance(on, str) else list(on)
    pairs = how == "inner" and not right_unique
    if isinstance(hot, str):
        hot = hot_keys(left, right if pairs else None, on, min_work)
    if hot is None:
        if distinct_left:
            left = left.repartition(*on).distinct()
        return left.join(right, on=on, how=how)

    if not pairs:
        hot_right = right.join(*_match(right, on, hot), "left_semi")
        if hot_right.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
            often = left.join(*_match(left, on, hot), "left_semi")
            seldom = left.join(*_match(left, on, hot), "left_anti")
            if distinct_left:
                often, seldom = often.distinct(), seldom.repartition(*on).distinct()
            return seldom.join(right, on=on, how=how).unionByName(often.join(F.broadcast(hot_right), on=on, how=how))

    own_left = _own_salt(left, left_by)
    if pairs:
        own_right, here = _own_salt(right, right_by), F.col("__split_left")
        cold = F.array(F.lit(0))
        salt_left = F.explode(F.when(here, F.array(own_left)).when(~here, _every_salt()).otherwise(cold))
        salt_right = F.when(here, _every_salt()).when(~here, F.array(own_right)).otherwise(cold)
    else:
        salt_left = F.coalesce(own_left, F.lit(0))
        salt_right = F.coalesce(_every_salt(), F.array(F.lit(0)))
    keys = [*on, SALT]
    left, right = _salted(left, on, hot, salt_left), _salted(right, on, hot, F.explode(salt_right))
    if distinct_left:
        left = left.repartition(*keys).distinct()
    return left.join(right, on=keys, how=how).drop(SALT)
