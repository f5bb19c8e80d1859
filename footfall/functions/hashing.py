"""Repeatable pseudo-random columns.

Draws are hashes of (seed, keys), so a retried or re-planned task produces the
same numbers on any executor. Nothing here uses ``rand()``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

U32 = 2**32


def salted_hash(salt: str, key: Column) -> Column:
    """First 32 bits of ``md5('salt:key')`` as a non-negative long.

    Used once per user for experiment splits and buckets, where a text salt is
    customary and other systems must be able to recompute the split.
    """
    digest = F.md5(F.concat(F.lit(f"{salt}:"), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def seeded_hash(seed: int, *keys: Column) -> Column:
    """Spark's own 32-bit hash of the keys as a non-negative long (cheap, code-generated)."""
    longs = [k.cast("bigint") for k in keys]
    return F.hash(F.lit(seed), *longs).cast("bigint").bitwiseAND(F.lit(U32 - 1))


def seeded_index(seed: int, size: int, *keys: Column) -> Column:
    """A draw from ``0 .. size-1``. Two hashes give 63 bits, so the modulo bias is negligible."""
    high = seeded_hash(seed, *keys).bitwiseAND(F.lit(2**31 - 1)) * F.lit(U32)
    return (high + seeded_hash(seed + 1, *keys)) % F.lit(size)


def poisson1_thresholds() -> list[int]:
    """Cumulative Poisson(1) probabilities scaled to 32 bits, up to the last that fits."""
    thresholds, cumulative, k = [], 0.0, 0
    while True:
        cumulative += math.exp(-1.0) / math.factorial(k)
        bound = math.floor(cumulative * U32)
        if thresholds and bound == thresholds[-1] or bound >= U32 - 1:
            return thresholds
        thresholds.append(bound)
        k += 1


def poisson1(uniform32: Column) -> Column:
    """Poisson(1) weight of a 32-bit uniform, by inverse distribution function."""
    bounds = poisson1_thresholds()
    weight = F.when(uniform32 < F.lit(bounds[0]), F.lit(0))
    for k, bound in enumerate(bounds[1:], start=1):
        weight = weight.when(uniform32 < F.lit(bound), F.lit(k))
    return weight.otherwise(F.lit(len(bounds))).cast("bigint")
