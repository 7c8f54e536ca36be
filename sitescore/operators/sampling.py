"""Row samples and splits that depend on the key only, not on the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Multiplicative congruential generator modulo a Mersenne prime.
_MULTIPLIER = 48271
_PRIME = 2147483647
_STEPS = 10000

SEED = 42
TEST_SHARE = 0.3


def key_bucket(key: Column, seed: int) -> Column:
    """Number in 0..9999 from a key; two rounds, so neighbours part.

    A key that is no whole number counts by the first digits of its MD5.
    """
    text = key.cast("string")
    number = F.coalesce(text.try_cast("bigint"), F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint"))
    once = F.pmod(F.pmod(number, F.lit(_PRIME)) * _MULTIPLIER + seed, F.lit(_PRIME))
    return F.pmod(F.pmod(once * _MULTIPLIER + seed, F.lit(_PRIME)), F.lit(_STEPS))


def sample_sites(df: DataFrame, fraction: float, seed: int = SEED, key: str = "site_id") -> DataFrame:
    """About ``fraction`` of the keys, without replacement."""
    return df.where(key_bucket(F.col(key), seed) < round(fraction * _STEPS))


def split(df: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED, key: str = "site_id") -> tuple[DataFrame, DataFrame]:
    """(train, test) with about ``test_share`` of the keys in test."""
    in_test = key_bucket(F.col(key), seed) < round(test_share * _STEPS)
    return df.where(~in_test), df.where(in_test)
