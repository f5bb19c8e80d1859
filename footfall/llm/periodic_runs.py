"""Runs of periodic words, found on a harmonic grid and extended exactly by a recompressed grammar.

A run is a stretch of words with smallest period ``q`` and at least ``max(6, 4 q)`` words that no neighbouring
word extends keeping the period.

* **Grid.** A run of period ``q`` covers four multiples of ``q`` in a row, so the words there are equal. One
  of each three neighbouring pairs of multiples is compared for every ``q`` up to a quarter of the text, which
  makes n/3 + n/6 + n/9 + … comparisons; where one agrees, the multiples beside it are compared too.
* **Grammar.** The texts with candidates are recompressed: alternately each block of one symbol becomes one
  symbol (symbol, length), and each neighbouring pair of a left and a right symbol becomes one symbol. Equal
  stretches get equal symbols but at their ends, level by level. A text ends with a symbol of its own.
* **Extension.** The longest common extension of two positions takes the highest level at which both begin
  with equal symbols (equal at one level is equal at all below), skips as many repeats of it as both have,
  and goes on behind. To the left the same tables hold the symbols that end at a position. No suffix array
  is built.

A run of a multiple of the smallest period has the same ends, so per stretch the smallest period stays.

Texts are handled in pieces of bounded size inside a task; a longer text alone. Nothing is shuffled.

Defined cases: a null or empty text has no words and no runs; repeated rows are each judged alone; an empty
table gives an empty table; of runs with equal exponents the first, then the shorter period is shown; further
columns are ignored. A long text takes memory in proportion to its own words. In ``made_periodic`` a null id has
no checksum and leaves its text alone.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from footfall.llm.common import map_texts, segments

LEAST, TIMES = 6, 4
#: Grid comparisons and extensions made at once.
SLICE = 1 << 20


# --- grammar --------------------------------------------------------------------------------


def named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers from 0 of the different pairs ``(a, b)``."""
    _, names = np.unique(a << np.int64(32) | b, return_inverse=True)
    return names


def right_side(symbols: np.ndarray, level: int) -> np.ndarray:
    """Whether a symbol stands right in the pairs of a level: a bit of its mixed number."""
    mixed = (symbols.astype(np.uint64) + np.uint64(level + 1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(40) & np.uint64(1)).astype(bool)


def repeats(symbols: np.ndarray) -> np.ndarray:
    """How many equal symbols stand from each place on."""
    ends = np.append(np.flatnonzero(symbols[1:] != symbols[:-1]) + 1, len(symbols))
    return np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(symbols))


class Grammar:
    """Recompression of a sequence of word numbers in which every text ends with a number of its own.

    For each position the symbols that begin there are kept, lowest level first, and the words that
    repeats of each cover; the same for symbols that end there.
    """

    def __init__(self, words: np.ndarray, levels: int):
        n = len(words)
        symbols, start = words.astype(np.int64), np.arange(n)
        next_name = int(symbols.max()) + 1 if n else 0
        kept = []
        for level in range(levels):
            size = np.diff(start, append=n)
            onward = repeats(symbols)
            backward = repeats(symbols[::-1])[::-1]
            kept.append([part.astype(np.int32) for part in (start, symbols, onward * size, backward * size)])
            if level % 2 == 0:  # blocks
                first = np.append(True, symbols[1:] != symbols[:-1]) if n else np.zeros(0, bool)
                length = onward[first]
                symbols, start = symbols[first].copy(), start[first]
                long = length > 1
                names = named(symbols[long], length[long])
                symbols[long] = names + next_name
            else:  # pairs; no two neighbours are equal here
                right = right_side(symbols, level)
                joined = ~right[:-1] & right[1:]
                at = np.flatnonzero(joined)
                names = named(symbols[at], symbols[at + 1])
                stays = np.append(True, ~joined)
                symbols = symbols.copy()
                symbols[at] = names + next_name
                symbols, start = symbols[stays], start[stays]
            next_name += int(names.max()) + 1 if len(names) else 0
        self.top = np.zeros(n + 1, dtype=np.int64)  # levels of which a symbol begins here
        for start, *_ in kept:
            self.top[start] += 1
        base = segments(self.top)
        self.base, total = base, int(base[-1])
        self.right = np.zeros(total, np.int32), np.zeros(total, np.int32)
        self.left = np.full(total, -1, np.int32), np.zeros(total, np.int32)
        for level in range(levels):
            start, symbols, onward, backward = kept[level]
            kept[level] = ()
            at = base[start] + level
            self.right[0][at], self.right[1][at] = symbols, onward
            self.left[0][at[1:]], self.left[1][at[1:]] = symbols[:-1], backward[:-1]

    def extend(self, i: np.ndarray, j: np.ndarray, leftward: bool = False) -> np.ndarray:
        """Words that agree from positions ``i < j`` on, or before them; both must lie in one text."""
        symbol, cover = self.left if leftward else self.right
        total = np.zeros(len(i), dtype=np.int64)
        on = np.arange(len(i))
        i, j = i.astype(np.int64).copy(), j.astype(np.int64).copy()
        while len(on):
            low = np.full(len(on), -1)
            high = np.minimum(self.top[i], self.top[j]) - 1
            a, b = self.base[i], self.base[j]
            while (open_ := low < high).any():  # the highest level with equal symbols
                middle = (low + high + 1) >> 1
                equal = open_ & (symbol[np.where(open_, a + middle, 0)] == symbol[np.where(open_, b + middle, 0)])
                low = np.where(equal, middle, low)
                high = np.where(open_ & ~equal, middle - 1, high)
            more = low >= 0
            if leftward:
                more &= i > 0
            on, i, j, a, b, low = on[more], i[more], j[more], a[more], b[more], low[more]
            step = np.minimum(cover[a + low], cover[b + low])
            total[on] += step
            i, j = (i - step, j - step) if leftward else (i + step, j + step)
        return total


# --- candidates -----------------------------------------------------------------------------


def grid(words: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text, place, period``: grid pairs that lie in four equal words, ``period`` apart; places are in ``words``."""
    periods = size // TIMES
    text = np.repeat(np.arange(len(size)), periods)
    period = np.arange(len(text)) - np.repeat(segments(periods)[:-1], periods) + 1
    n = size[text]
    multiples = -(-n // period)
    tests = multiples // 3
    ends = segments(tests)
    found = []
    low = 0
    while low < len(text):
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + SLICE, side="right")) - 1)
        own = slice(low, high)
        count = tests[own]
        which = np.repeat(np.arange(low, high), count)
        k = 1 + 3 * (np.arange(len(which)) - np.repeat(ends[own] - ends[low], count))
        q = period[which]
        at = first[text[which]] + k * q
        same = words[at] == words[at + q]
        which, k, q, at = which[same], k[same], q[same], at[same]
        word, most = words[at], multiples[which]
        row = np.full(len(which), 2)
        for way in (-1, 1):
            still = np.ones(len(which), dtype=bool)
            for far in (1, 2):
                other = k - far if way < 0 else k + 1 + far
                still &= (other >= 0) & (other < most)
                still[still] = words[first[text[which[still]]] + other[still] * q[still]] == word[still]
                row += still
        kept = row >= TIMES
        found.append((text[which[kept]], at[kept], q[kept]))
        low = high
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*found))


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Per text of word numbers, rows ``start, length, period`` by start, then period."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    words = np.concatenate([np.zeros(0, np.int64), *texts])
    text, place, period = grid(words, segments(size)[:-1], size)
    found: list[np.ndarray] = [np.zeros((0, 3), np.int64)] * len(texts)
    if not len(text):
        return found
    held, own = np.unique(text, return_inverse=True)
    most = int(words.max()) + 1
    joined = np.concatenate([np.append(texts[t], most + number) for number, t in enumerate(held)])
    first = segments(size[held] + 1)[:-1]
    levels = 2 + 5 * int(size[held].max()).bit_length()  # a pair of levels takes away a quarter
    grammar = Grammar(joined, levels)
    at = place - segments(size)[:-1][text] + first[own]
    rows = []
    for low in range(0, len(at), SLICE):
        i, q, o = at[low : low + SLICE], period[low : low + SLICE], own[low : low + SLICE]
        onward = grammar.extend(i, i + q)
        back = grammar.extend(i, i + q, leftward=True)
        length = onward + back + q
        ok = length >= np.maximum(LEAST, TIMES * q)
        rows.append(np.stack([o[ok], (i - back - first[o])[ok], length[ok], q[ok]], axis=1))
    runs = np.unique(np.concatenate(rows), axis=0)  # by text, start, length, period
    shortest = np.ones(len(runs), dtype=bool)
    shortest[1:] = (runs[1:, :3] != runs[:-1, :3]).any(axis=1)
    runs = runs[shortest]
    runs = runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]
    cuts = np.searchsorted(runs[:, 0], np.arange(len(held) + 1))
    for number, t in enumerate(held):
        found[t] = runs[cuts[number] : cuts[number + 1], 1:]
    return found


# --- texts ----------------------------------------------------------------------------------


def word_lists(texts: list[str]) -> tuple[list[np.ndarray], list[bytes]]:
    """Word numbers of each text, and the different words; words end at ASCII white space."""
    split = [t.encode().split() for t in texts]
    sizes = segments(np.array([len(s) for s in split], dtype=np.int64))
    words = pa.array([w for own in split for w in own], pa.large_binary()).dictionary_encode()
    numbers = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return [numbers[a:b] for a, b in zip(sizes[:-1], sizes[1:])], words.dictionary.to_pylist()


def made_periodic(words: np.ndarray, key: int | None) -> np.ndarray:
    """One text in ten, by checksum of its id, repeats a stretch of its words from some word on."""
    if key is None or not len(words):
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return words[np.where(i >= a, a + (i - a) % p, i)]


def without_repeats(words: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """The words that lie in no run behind its first period."""
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return words[np.cumsum(change[:-1]) == 0]


def summary(words: np.ndarray, runs: np.ndarray, names: list[bytes]) -> tuple:
    """One text's columns of ``digest``, but for its id."""
    best = None
    for s, length, q in runs.tolist():
        exponent = Fraction(length, q)
        if best is None or exponent > best[0]:
            best = (exponent, s, length, q)
    shown = (*best[1:], 1000 * best[2] // best[3]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs.tolist())
    kept = b" ".join([names[w] for w in without_repeats(words, runs).tolist()])
    return len(runs), *shown, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def detect(docs: DataFrame, key: Column, text: Column) -> DataFrame:
    """``doc_id, runs, collapsed``: all runs of every text, and the text without their repeats."""

    def run(texts, rows):
        words, names = word_lists(texts)
        found = find_runs(words)
        return {
            "doc_id": rows.column(1),
            "runs": [[dict(zip(("start", "length", "period"), r)) for r in own.tolist()] for own in found],
            "collapsed": [
                b" ".join([names[w] for w in without_repeats(own, runs).tolist()]).decode() for own, runs in zip(words, found)
            ],
        }

    schema = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return map_texts(docs, [text, key.cast("long").alias("doc_id")], run, schema, 2 << 20)


def digest(docs: DataFrame, key: Column, text: Column) -> DataFrame:
    """Counts, greatest run and checksums per row, of texts of which one in ten is made periodic."""
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")

    def run(texts, rows):
        words, names = word_lists(texts)
        words = [made_periodic(own, key) for own, key in zip(words, rows.column(1).to_pylist())]
        out = [summary(own, runs, names) for own, runs in zip(words, find_runs(words))]
        return {"doc_id": rows.column(1), **dict(zip(columns, zip(*out)))}

    schema = (
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string"
    )
    return map_texts(docs, [text, key.cast("long").alias("doc_id")], run, schema, 2 << 20)
