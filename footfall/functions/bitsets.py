"""Sets of small whole numbers held as bits of a few long columns.

Which days or weeks a user was active fits in a handful of longs. ``bit_or`` over
longs stays in hash aggregation with map-side combining, while collecting sets of
dates makes Spark sort every event of a task once it has seen a few users.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 62


def _names(size: int) -> list[str]:
    return [f"_bits{w}" for w in range((size + WORD - 1) // WORD)]


def collect_bits(index: Column, size: int) -> list[Column]:
    """Aggregates that remember which of ``0 .. size-1`` occurred; other values are ignored."""
    columns = []
    for w, name in enumerate(_names(size)):
        low, high = w * WORD, min((w + 1) * WORD, size) - 1
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (index - low).cast("int"))
        seen = F.when((index >= low) & (index <= high), bit)
        columns.append(F.coalesce(F.bit_or(seen), F.lit(0).cast("bigint")).alias(name))
    return columns


def merge_bits(size: int) -> list[Column]:
    """Aggregates that unite sets of positions below ``size``."""
    return [F.bit_or(name).alias(name) for name in _names(size)]


def has_bit(position: Column, size: int) -> Column:
    """Whether a position between ``0`` and ``size-1`` occurred."""
    words = _names(size)
    word = F.get(F.array(*words), F.floor(position / WORD).cast("int"))
    return F.getbit(word, (position % WORD).cast("int")) == 1


def members(size: int) -> Column:
    """The positions that occurred, in order."""
    return F.filter(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: has_bit(i, size))
