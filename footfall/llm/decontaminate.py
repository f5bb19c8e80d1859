"""Benchmark decontamination by the CGK embedding and bit-sampling LSH over item-sized windows.

Texts and items are lower-cased and stripped of white space and ASCII punctuation; distances are
edits of the remaining UTF-8 bytes. A document is contaminated by an item when a part of it lies
within ``error`` times the item's length of the whole item.

1. **Windows worth a walk.** An item with at most k edits, cut into k + 2 pieces, leaves two pieces as they
   are, and their places in a text differ from those in the item by shifts at most k apart. So the eight-byte (or
   shorter) heads of all pieces are looked up at every byte of a text, and only where two different pieces of an item
   agree can the item stand. The test loses nothing, at any edits up to k.
2. **Walk.** From each place that such a piece gives, a window as long as the item (as the shortest item of its size
   class; a class spans a factor of 1.4) walks with the item's own bytes: at each of ``3 * window`` steps the walk
   writes its byte and moves on by a random bit of (step, byte), so a few edits leave most steps equal in Hamming terms.
3. **Bit sampling.** A round hashes the bytes written at ``samples`` random steps. A window and an item are
   candidates when they agree in one of the rounds, whose number is derived, class by class, from the benchmark:
   the fewest that find ``recall`` of simulated copies of its own items with ``error`` edits. Classes that
   ``MOST_ROUNDS`` rounds don't bring that far have every window verified.
4. **Verification.** Candidates of one item and text that overlap are merged and verified once by exact edit distance.

Items of more than ``LONGEST`` bytes are indexed as parts of about equal size, of which one has at most its share of the
edits; they are verified whole. An index is built for blocks of at most ``block_chars`` benchmark characters. Each
block is one pass over the documents, and tasks get its items, not tables that grow with them in memory.

Defined cases: null and empty texts hold no item; an item under ``least`` bytes identifies nothing within
a text (a benchmark's one-word answers are not removed from the language) and contaminates a text equal to it (one
without any byte, none); repeated items and rows are judged alike; items or documents without rows give no findings;
null ids stay null; further columns are ignored by ``find_items`` and kept by ``drop_contaminated``; a text that
repeats one piece over and over is one merged candidate per item.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import filter_texts, map_texts, per_process, segments

STRIPPED = bytes(b for b in range(128) if not chr(b).isalnum())
#: Longest unit of the index, most rounds, rounds tried at once, copies simulated per class, places of a text looked up at once.
LONGEST, MOST_ROUNDS, TOGETHER, COPIES, PLACES = 512, 160, 16, 200, 1 << 18
#: Codes of bytes; further ones share.
CODES = 32
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MAYBE_BITS = 22


def normal(text: str) -> bytes:
    return text.lower().encode().translate(None, STRIPPED)


def edit_within(item: bytes, part: bytes, limit: int) -> int | None:
    """Fewest edits between ``item`` and any substring of ``part``, if at most ``limit``.

    The matrix's column is held as bits of two integers, one column per byte of ``part``.
    """
    n = len(item)
    masks: dict[int, int] = {}
    for i, byte in enumerate(item):
        masks[byte] = masks.get(byte, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << n - 1
    up, down, score, best = full, 0, n, n
    for byte in part:
        match = masks.get(byte, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        right_up = down | ~(diagonal | up) & full
        right_down = up & diagonal
        if right_up & top:
            score += 1
        elif right_down & top:
            score -= 1
        right_up = right_up << 1 & full
        right_down = right_down << 1 & full
        up = right_down | ~(diagonal | right_up) & full
        down = right_up & diagonal
        best = min(best, score)
    return best if best <= limit else None


# --- walks ----------------------------------------------------------------------------------


class Walks:
    """Independent walks over windows of one size, each with its own sampled steps.

    ``after[round, code, step]`` is the step at which the walk leaves a byte that it reached at ``step``;
    ``part`` sums random numbers of (sampled step, byte) over the steps in between, ``padding`` over those
    that are left when the window ends.
    """

    def __init__(self, window: int, samples: int, seed: int, rounds: int, codes: int = CODES):
        steps = 3 * window
        self.window, self.width, self.rounds = window, steps + 1, rounds
        self.after = np.zeros((rounds, codes, steps + 1), dtype=np.int32)
        self.part = np.zeros((rounds, codes, steps + 1), dtype=np.int32)
        self.padding = np.zeros((rounds, steps + 1), dtype=np.int32)
        for r in range(rounds):
            rng = np.random.default_rng([seed, window, r])
            moves = rng.integers(0, 2, size=(codes, steps), dtype=np.int8).astype(bool)
            moves[:, -1] = True
            # beyond two windows of steps most walks have ended and show nothing but padding
            picked = rng.choice(2 * window, size=min(samples, 2 * window), replace=False)
            weight = np.zeros((codes + 1, steps), dtype=np.int32)
            weight[:, picked] = rng.integers(-(1 << 31), 1 << 31, size=(codes + 1, len(picked)), dtype=np.int64)
            step = np.where(moves, np.arange(steps), steps)
            nearest = np.minimum.accumulate(step[:, ::-1], axis=1)[:, ::-1]  # the move at or after a step
            after = np.full((codes, steps + 1), steps)
            after[:, :-1] = np.minimum(nearest + 1, steps)
            sums = np.zeros((codes + 1, steps + 1), dtype=np.int32)
            sums[:, 1:] = np.cumsum(weight, axis=1, dtype=np.int32)  # wraps around, like all keys
            self.after[r] = after
            self.part[r] = sums[np.arange(codes)[:, None], after] - sums[:codes]
            self.padding[r] = sums[codes, -1] - sums[codes]

    def keys(self, windows: np.ndarray, low: int, high: int) -> np.ndarray:
        """Keys of rounds ``low`` to ``high``, a row each, of windows given as rows of codes."""
        n, width = len(windows), self.width
        part, after = self.part[low:high].reshape(-1), self.after[low:high].reshape(-1)
        rounds = (np.arange(high - low) * (self.after.shape[1] * width))[:, None]
        reached = np.zeros((high - low, n), dtype=np.int64)
        key = np.zeros((high - low, n), dtype=np.int32)
        for column in windows.T.astype(np.int64) * width:
            at = rounds + column + reached
            key += part.take(at)
            reached = after.take(at)
        return key + np.take_along_axis(self.padding[low:high], reached, axis=1)


# --- index ----------------------------------------------------------------------------------


def class_of(size: int) -> int:
    """Half an octave of sizes."""
    return int(2 * np.log2(size))


class Index:
    """Pieces and windows of a block of items; ``rounds`` per size class, ``None`` to verify every window."""

    def __init__(
        self, items: list[tuple[int | None, bytes]], error: float = 0.1, samples: int = 4, seed: int = 7,
        rounds: dict[int, int | None] | None = None, least: int = 24,
    ):
        self.error = error
        self.items = [(i, t) for i, t in items if len(t) >= least]
        self.whole: dict[bytes, list] = {}
        for i, t in items:
            if 0 < len(t) < least:
                self.whole.setdefault(t, []).append(i)
        self.units: list[bytes] = []  # an item, or a part of a long one
        owner, shift = [], []
        for number, (_, text) in enumerate(self.items):
            parts = -(-len(text) // LONGEST)
            cuts = [len(text) * p // parts for p in range(parts + 1)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                self.units.append(text[a:b])
                owner.append(number)
                shift.append(a)
        self.owner, self.shift = np.array(owner, np.int64), np.array(shift, np.int64)
        self.limit = np.array([int(error * len(u)) for u in self.units], dtype=np.int64)
        self._pieces()
        self._windows(samples, seed, rounds)

    def _pieces(self) -> None:
        """Heads of all pieces, by their length."""
        found: dict[int, list] = {}
        for number, text in enumerate(self.units):
            pieces = int(self.limit[number]) + 2
            size = min(8, len(text) // pieces)
            for piece in range(pieces):
                at = len(text) * piece // pieces
                found.setdefault(size, []).append((int.from_bytes(text[at : at + size], "little"), number, at))
        self.heads = []
        for size, rows in sorted(found.items()):
            rows.sort()
            head = np.array([r[0] for r in rows], dtype=np.uint64)
            different, first = np.unique(head, return_index=True)
            maybe = np.zeros(1 << MAYBE_BITS, dtype=bool)
            maybe[different * GOLDEN >> np.uint64(64 - MAYBE_BITS)] = True
            unit, at = (np.array([r[c] for r in rows], dtype=np.int64) for c in (1, 2))
            self.heads.append((np.uint64((1 << 8 * size) - 1), maybe, different, np.append(first, len(rows)), unit, at))

    def _windows(self, samples: int, seed: int, rounds: dict[int, int | None] | None) -> None:
        letters = np.bincount(np.frombuffer(b"".join(self.units), np.uint8), minlength=256)
        self.code = np.zeros(256, dtype=np.uint8)
        for rank, byte in enumerate(np.argsort(-letters, kind="stable")):
            self.code[byte] = min(rank + 1, CODES - 1) if letters[byte] else 0
        classes: dict[int, list[int]] = {}
        for number, text in enumerate(self.units):
            classes.setdefault(class_of(len(text)), []).append(number)
        self.kind = np.zeros(len(self.units), dtype=np.int64)
        self.rank = np.zeros(len(self.units), dtype=np.int64)
        self.classes = {}
        for kind, numbers in sorted(classes.items()):
            self.kind[numbers], self.rank[numbers] = kind, np.arange(len(numbers))
            tried = MOST_ROUNDS if rounds is None else rounds[kind]
            if tried is None:
                continue
            walks = Walks(min(len(self.units[n]) for n in numbers), samples, seed, tried)
            own = np.stack([self.code[np.frombuffer(self.units[n], np.uint8, walks.window)] for n in numbers])
            self.classes[kind] = walks, walks.keys(own, 0, tried)

    def places(self, joined: bytes, starts: np.ndarray) -> np.ndarray:
        """Columns ``text, unit, place`` where two different pieces of a unit agree, in order.

        ``joined`` holds the texts, each with a zero byte behind, from ``starts`` on.
        """
        data = joined + bytes(8)
        loads = np.ndarray((len(joined),), dtype="<u8", buffer=data, strides=(1,))
        found = []
        for low in range(0, len(joined), PLACES):
            own = loads[low : low + PLACES].copy()
            for mask, maybe, different, first, unit, at in self.heads:
                head = own & mask
                here = np.flatnonzero(maybe[head * GOLDEN >> np.uint64(64 - MAYBE_BITS)])
                which = np.searchsorted(different, head[here])
                same = different[np.minimum(which, len(different) - 1)] == head[here]
                here, which = here[same], which[same]
                times = first[which + 1] - first[which]
                entry = np.repeat(first[which] - segments(times)[:-1], times) + np.arange(times.sum())
                found.append(np.stack([np.repeat(here, times) + low, unit[entry], at[entry]]))
        if not found:
            return np.zeros((3, 0), dtype=np.int64)
        position, unit, at = np.concatenate(found, axis=1)
        text = np.searchsorted(starts, position, side="right") - 1
        place = position - at
        order = np.lexsort((at, place, unit, text))
        text, unit, place, at = text[order], unit[order], place[order], at[order]
        pair = (text[1:] == text[:-1]) & (unit[1:] == unit[:-1]) & (at[1:] != at[:-1])
        pair &= place[1:] - place[:-1] <= self.limit[unit[1:]]
        kept = np.append(pair, False) | np.append(False, pair) if len(text) else np.zeros(0, bool)
        rows = np.stack([text[kept], unit[kept], place[kept]])
        if not rows.shape[1]:
            return rows
        fresh = np.append(True, (rows[:, 1:] != rows[:, :-1]).any(axis=0))
        return rows[:, fresh]

    def first_rounds(self, joined: bytes, units: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The first round in which each window agrees with its unit, or -1; 0 where no round is asked."""
        edge = LONGEST
        text = np.zeros(len(joined) + 2 * edge, dtype=np.uint8)
        text[edge : edge + len(joined)] = self.code[np.frombuffer(joined, np.uint8)]
        found = np.where(np.isin(self.kind[units], list(self.classes)), -1, 0)
        for kind, (walks, keys) in self.classes.items():
            of_kind = np.flatnonzero(self.kind[units] == kind)
            for low in range(0, len(of_kind), 1 << 11):
                own = of_kind[low : low + (1 << 11)]
                rows = text[(places[own] + edge).clip(0, len(text) - walks.window)[:, None] + np.arange(walks.window)]
                for r in range(0, walks.rounds, TOGETHER):
                    if not len(own):
                        break
                    last = min(r + TOGETHER, walks.rounds)
                    agree = walks.keys(rows, r, last) == keys[r:last, self.rank[units[own]]]
                    hit = agree.any(axis=0)
                    found[own[hit]] = r + agree[:, hit].argmax(axis=0)
                    own, rows = own[~hit], rows[~hit]
        return found

    def recall(self, seed: int, copies: int = COPIES) -> dict[int, np.ndarray]:
        """Per class, the first round that finds each of the simulated copies (-1: none does)."""
        rng = np.random.default_rng(seed)
        out = {}
        for kind in self.classes:
            numbers = rng.choice(np.flatnonzero(self.kind == kind), copies)
            texts = []
            for number in numbers:
                around = [self.units[n][:64] for n in rng.integers(0, len(self.units), 2)]
                part = list(self.units[number])
                for change in rng.integers(0, 3, int(self.limit[number])):
                    at = rng.integers(len(part))
                    part[at : at + (change != 2)] = [] if change == 1 else [part[rng.integers(len(part))]]
                texts.append(around[0] + bytes(part) + around[1])
            joined, starts = joined_texts(texts)
            text, unit, place = self.places(joined, starts)
            own = unit == numbers[text]
            rounds = self.first_rounds(joined, unit[own], place[own])
            first = np.full(copies, MOST_ROUNDS)
            np.minimum.at(first, text[own][rounds >= 0], rounds[rounds >= 0])
            out[kind] = np.where(first < MOST_ROUNDS, first, -1)
        return out

    def find(self, texts: list[bytes]) -> list[list[tuple[int | None, int, int]]]:
        """Per text, ``(item_id, place, edits)`` for each item found, at its first verified place."""
        found: list[list] = [[(i, 0, 0) for i in self.whole.get(text, ())] for text in texts]
        if not self.units:
            return found
        joined, starts = joined_texts(texts)
        text, unit, place = self.places(joined, starts)
        agreed = self.first_rounds(joined, unit, place) >= 0
        if not agreed.any():
            return found
        text, unit, place = text[agreed], unit[agreed], place[agreed]
        item, place = self.owner[unit], place - self.shift[unit] - starts[text]
        size = np.array([len(t) for _, t in self.items], dtype=np.int64)
        order = np.lexsort((place, item, text))
        text, item, place = text[order], item[order], place[order]
        gap = size[item]  # overlapping candidates are one
        fresh = np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (place[1:] - place[:-1] > gap[1:]))
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(text)) - 1
        done = set()
        for d, number, low, high in zip(text[first].tolist(), item[first].tolist(), place[first].tolist(), place[last].tolist()):
            if (d, number) in done:
                continue
            item_id, own = self.items[number]
            limit = int(self.error * len(own))
            part = texts[d][max(0, low - 2 * limit) : max(0, high + len(own) + 2 * limit)]
            edits = 0 if own in part else edit_within(own, part, limit)
            if edits is not None:
                done.add((d, number))
                found[d].append((item_id, max(0, low), edits))
        return found


def joined_texts(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """Texts with a zero byte behind each, which no normal text holds, and where they start."""
    return b"\0".join(texts) + b"\0", segments(np.array([len(t) + 1 for t in texts], dtype=np.int64))[:-1]


# --- jobs -----------------------------------------------------------------------------------


def rounds_of(index: Index, recall: float, seed: int) -> dict[int, int | None]:
    """Per size class the fewest rounds that reach ``recall`` on simulated copies, if so many do."""
    rounds: dict[int, int | None] = {}
    for kind, first in index.recall(seed).items():
        needed = np.sort(np.where(first < 0, MOST_ROUNDS, first))[int(np.ceil(recall * len(first))) - 1]
        rounds[kind] = int(needed) + 1 if needed < MOST_ROUNDS else None
    return rounds


def searches(
    benchmark: DataFrame, item: Column, text: Column, error: float, samples: int, seed: int, block_chars: int,
    recall: float, least: int,
):
    """Per block of the benchmark, a function that finds its items in texts.

    Tasks get the block's items and rounds as plain values; a worker builds the index once and keeps one at a time.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(item.cast("long").alias("item"), F.coalesce(text, F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = total // block_chars + 1
    number = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for block in range(blocks):
        rows = items.where(number == block).distinct().collect()
        own = sorted({(r.item, normal(r.text)) for r in rows}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        rounds = rounds_of(Index(own, error, samples, seed, least=least), recall, seed)
        name = f"{zlib.crc32(repr((own, error, samples, seed, least)).encode())}-{len(own)}-{block}"
        shared = spark.sparkContext.broadcast((own, rounds))

        def find(texts: list[str], shared=shared, name=name) -> list[list[tuple[int | None, int, int]]]:
            kept = per_process("decontamination", dict)
            if name not in kept:
                kept.clear()
                kept[name] = Index(shared.value[0], error, samples, seed, shared.value[1], least)
            return kept[name].find([normal(t) for t in texts])

        yield find


def find_items(
    docs: DataFrame,
    key: Column,
    text: Column,
    benchmark: DataFrame,
    item: Column,
    item_text: Column,
    error: float = 0.1,
    samples: int = 4,
    seed: int = 7,
    block_chars: int = 2 << 20,
    recall: float = 0.99,
    least: int = 24,
) -> DataFrame:
    """``doc_id, item_id, place, edits`` per document row and item that it holds."""

    def search(find):
        def run(texts, rows):
            keys = rows.column(1).to_pylist()
            flat = [(keys[d], *hit) for d, found in enumerate(find(texts)) for hit in found]
            return dict(zip(("doc_id", "item_id", "place", "edits"), zip(*flat))) if flat else None

        schema = "doc_id long, item_id long, place long, edits long"
        return map_texts(docs, [text, key.cast("long").alias("doc_id")], run, schema, 2 << 20)

    finders = searches(benchmark, item, item_text, error, samples, seed, block_chars, recall, least)
    return reduce(DataFrame.unionByName, [search(find) for find in finders])


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    error: float = 0.1,
    samples: int = 4,
    seed: int = 7,
    block_chars: int = 2 << 20,
    recall: float = 0.99,
    least: int = 24,
) -> DataFrame:
    """The rows that hold no item, with all their columns; one pass per block of the benchmark."""
    for find in searches(
        benchmark, F.col(f"`{item}`"), F.col(f"`{item_text}`"), error, samples, seed, block_chars, recall, least
    ):
        docs = filter_texts(docs, text, lambda texts, find=find: [not hits for hits in find(texts)])
    return docs
