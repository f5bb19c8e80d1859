"""Quality rules: word repetition and zstandard compression bands.

The ratio of a text is its UTF-8 size over its compressed size. Repetitive text compresses far
better than prose of its length and noise far worse, so each length class has a lower and an upper
limit. The whole text is held to the limits of its size and, from two full chunks on, each fixed
chunk to the limits of a chunk; a text goes when more than ``chunk_share`` of its chunks are out.

Defined cases: a null or empty text has no words and fails the base rule; texts of any length are
compressed whole; repeated rows are judged alike; an empty table gives an empty table; further
columns are ignored by ``measure`` and kept untouched by ``keep_good``.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import count

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import SPACES, filter_texts, map_texts

Bands = tuple[tuple[int, float, float], ...]

#: Smallest size in bytes, lowest and highest ratio that are accepted from that size on.
BANDS: Bands = (
    (0, 0.0, 2.0),
    (100, 0.8, 2.5),
    (300, 1.2, 2.8),
    (1_000, 1.4, 3.0),
    (3_000, 1.5, 3.4),
    (10_000, 1.6, 3.8),
    (30_000, 1.6, 4.2),
)
CHUNK = 4096
LEVEL = 3

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, n_chunks long, n_chunks_out long"
)


def band(size: int, bands: Bands = BANDS) -> tuple[float, float]:
    return next((low, high) for least, low, high in reversed(bands) if size >= least)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more in the text."""
    if len(words) < 4:
        return 0
    ids = defaultdict(count().__next__)
    w = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    pair = w[:-2] * len(ids) + w[1:-1]
    if len(ids) >= 1 << 21:  # keep three numbers within 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, place, times = np.unique(pair * len(ids) + w[2:], return_inverse=True, return_counts=True)
    twice = times[place] > 1
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : len(words) - 2 + shift] |= twice
    return int(covered.sum())


def word_rules(raw: bytes) -> tuple[int, int, bool]:
    """Words, repeated words, and whether the text fails by them."""
    words = raw.split()
    repeats = repeated_words(words)
    return len(words), repeats, len(words) < 50 or 100 * repeats > 50 * len(words)


def judge(text: str, compress, chunk_share: float = 0.3, bands: Bands = BANDS) -> tuple:
    """The values of ``FIELDS`` for one text."""
    raw = text.encode()
    n_words, repeats, failed = word_rules(raw)
    lines = Counter(line for line in raw.split(b"\n") if line.strip(SPACES))
    ratio = len(raw) / len(compress(raw)) if raw else 0.0
    low, high = band(len(raw), bands)
    fine = low <= ratio <= high
    chunks = out = 0
    if len(raw) >= CHUNK:
        low, high = band(CHUNK, bands)
        last = len(raw) - CHUNK
        for start in [*range(0, last, CHUNK), last]:
            chunks += 1
            out += not low <= CHUNK / len(compress(raw[start : start + CHUNK])) <= high
    return (
        n_words,
        len(text) - (len(raw) - len(raw.translate(None, SPACES))),
        len(raw) - len(raw.translate(None, b"#*$%&|<>")),
        sum(lines.values()) - len(lines),
        repeats,
        failed,
        not failed and fine and out <= chunk_share * chunks,
        ratio,
        chunks,
        out,
    )


def fit_bands(docs: DataFrame, text: Column, trim: float = 0.02, width: float = 2.5, enough: int = 200) -> Bands:
    """Limits of every length class, from all texts; one row per class reaches the driver."""

    def run(texts, rows):
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        raws = [raw for raw in (t.encode() for t in texts) if not word_rules(raw)[2]]
        return {"size": list(map(len, raws)), "packed": [len(compress(raw)) for raw in raws]}

    different = map_texts(docs, [text], run, "size long, packed long").distinct()
    ratio, shares = F.col("size") / F.col("packed"), F.array(F.lit(trim), F.lit(0.5), F.lit(1 - trim))
    fitted = (
        different.groupBy((F.length(F.bin("size")) - 1).alias("power"))
        .agg(F.percentile_approx(ratio, shares, 10_000).alias("q"), F.count("*").alias("n"))
        .where(F.col("n") >= enough)
        .collect()
    )
    limits = {r.power: (r.q[1] - width * (r.q[1] - r.q[0]), r.q[1] + width * (r.q[2] - r.q[1])) for r in fitted}
    return ((0, *band(0)), *((1 << power, *limits.get(power, band(1 << power))) for power in range(63)))


def measure(
    docs: DataFrame, key: Column, text: Column, chunk_share: float = 0.3, bands: Bands | None = None
) -> DataFrame:
    """``doc_id`` and the values of ``FIELDS`` for every row; limits are fitted unless given."""
    bands = fit_bands(docs, text) if bands is None else bands

    def run(texts, rows):
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        found = list(zip(*(judge(t, compress, chunk_share, bands) for t in texts)))
        names = [f.split()[0] for f in FIELDS.split(", ")]
        return {"doc_id": rows.column(1), **dict(zip(names, found))}

    return map_texts(docs, [text, key.cast("long").alias("doc_id")], run, f"doc_id long, {FIELDS}")


def keep_good(docs: DataFrame, text: str = "text", chunk_share: float = 0.3, bands: Bands | None = None) -> DataFrame:
    """The rows whose verdict is to keep, with all their columns; limits are fitted unless given."""
    bands = fit_bands(docs, F.col(f"`{text}`")) if bands is None else bands

    def run(texts):
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        return [judge(t, compress, chunk_share, bands)[6] for t in texts]

    return filter_texts(docs, text, run)
