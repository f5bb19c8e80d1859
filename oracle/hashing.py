"""Spark's 32-bit hash of integers, spelled out in portable SQL.

Spark's ``hash`` is the public Murmur3 x86 32-bit function with seed 42, where the
hash of one argument is the seed of the next.
"""

from __future__ import annotations

MASK = 0xFFFFFFFF
# Fixed values of the Murmur3 algorithm.
C1, C2, C3 = 0xCC9E2D51, 0x1B873593, 0xE6546B64
F1, F2 = 0x85EBCA6B, 0xC2B2AE35
SPARK_SEED = 42


def hash_int(value: int, seed: int = SPARK_SEED) -> int:
    """Hash of one 32-bit integer, for constants."""
    k = value * C1 & MASK
    k = (k << 15 | k >> 17) & MASK
    h = seed ^ (k * C2 & MASK)
    h = (h << 13 | h >> 19) & MASK
    h = (h * 5 + C3) & MASK
    h ^= 4
    h = (h ^ h >> 16) * F1 & MASK
    h = (h ^ h >> 13) * F2 & MASK
    return h ^ h >> 16


def _u(value: int) -> str:
    return f"{value}::UBIGINT"


def _times(column: str, factor: int) -> str:
    return f"({column} * {_u(factor)}) & {_u(MASK)}"


def _turn(column: str, bits: int) -> str:
    return f"(({column} << {bits}) & {_u(MASK)}) | ({column} >> {32 - bits})"


def hashed(source: str, keys: list[str], start: str) -> str:
    """``SELECT`` of all columns of ``source`` plus ``h``, the hash of its bigint key columns.

    ``start`` is an SQL expression for the seed.
    """
    sql = f"SELECT *, ({start})::UBIGINT AS h, 0::UBIGINT AS k FROM {source}"

    def step(column: str, expression: str) -> None:
        nonlocal sql
        sql = f"SELECT * REPLACE ({expression} AS {column}) FROM ({sql})"

    for key in keys:
        for word in (f"{key}::UBIGINT & {_u(MASK)}", f"{key}::UBIGINT >> 32"):
            step("k", word)
            step("k", _times("k", C1))
            step("k", _turn("k", 15))
            step("k", _times("k", C2))
            step("h", "xor(h, k)")
            step("h", _turn("h", 13))
            step("h", f"(h * 5::UBIGINT + {_u(C3)}) & {_u(MASK)}")
        step("h", f"xor(h, {_u(8)})")
        step("h", "xor(h, h >> 16)")
        step("h", _times("h", F1))
        step("h", "xor(h, h >> 13)")
        step("h", _times("h", F2))
        step("h", "xor(h, h >> 16)")
    return f"SELECT * EXCLUDE (k) FROM ({sql})"
