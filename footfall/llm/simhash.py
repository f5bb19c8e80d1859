"""SimHash near-duplicates, searched by covering anchors.

A fingerprint holds 64 majority bits of the XXH64 values of a text's word shingles. Its first and
second half are each read as a 31-bit word (the last bit of a half is compared but not indexed).
Two fingerprints within ``distance`` bits differ by at most ``distance // 2`` bits in one half.
The anchors of a half are the 2**26 codewords of the Hamming code of length 31, a perfect code of
covering radius 1. A fingerprint is at home at the one anchor within the covering radius, and is
replicated to every anchor within covering radius plus threshold (1 + 1: about 16 of them). The
home anchor of one member of a linked pair is therefore always visited by the other, and homes are
compared with visitors anchor by anchor.

Equal fingerprints are one before the search. An anchor with very many homes is split: its homes
are dealt out by hash and its visitors go to each part. A part emits a spanning forest of what it
linked, never all pairs, and components come from alternating star contraction on those edges.

Defined cases: null and empty texts have fingerprint zero and link like any other; a null
``doc_id`` is linked but never a representative (``component_id`` is null when a component has no
other); repeated rows come back as often as given; empty tables give empty tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import free_name, map_texts, segments, shuffle_partitions
from footfall.llm.graph import components, forest
from footfall.session import materialise

SEED = 42
BITS = 31  # length of the code
PARITY = 5


def shingles(words: list[bytes], length: int) -> list[bytes]:
    if len(words) <= length:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends]
    return [joined[starts[i] : ends[i + length - 1] - 1] for i in range(len(words) - length + 1)]


def fingerprints_of(texts: list[str], length: int = 3) -> np.ndarray:
    """Fingerprints as unsigned 64-bit numbers."""
    digest = xxhash.xxh64_intdigest
    hashes, sizes = [], []
    for text in texts:
        found = [digest(s, SEED) for s in shingles(text.encode().lower().split(), length)]
        hashes.append(np.array(found, dtype="<u8"))
        sizes.append(len(found))
    flat, ends = np.concatenate(hashes) if hashes else np.zeros(0, "<u8"), segments(np.array(sizes, dtype=np.int64))
    ones = np.zeros((len(texts), 64), dtype=np.int64)
    step = 1 << 17
    for low in range(0, len(flat), step):  # texts may go over the cuts
        part = flat[low : low + step]
        first = int(np.searchsorted(ends, low, side="right")) - 1
        last = int(np.searchsorted(ends, low + len(part), side="left"))
        filled = [d for d in range(first, last) if ends[d + 1] > max(low, ends[d])]
        cuts = [max(0, ends[d] - low) for d in filled]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[filled] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    majority = ones * 2 > np.array(sizes, dtype=np.int64)[:, None]
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprint(docs: DataFrame, key: Column, text: Column, length: int = 3) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long."""

    def run(texts, rows):
        return {"doc_id": rows.column(1), "fp": fingerprints_of(texts, length).view(np.int64)}

    return map_texts(docs, [text, key.cast("long").alias("doc_id")], run, "doc_id long, fp long")


def _halves(fp: np.ndarray) -> list[np.ndarray]:
    bits = fp.view(np.uint64)
    mask = np.uint64((1 << BITS) - 1)
    return [bits & mask, (bits >> np.uint64(32)) & mask]


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Of the Hamming code whose parity check has column i + 1 at bit i."""
    out = np.zeros(len(words), dtype=np.int64)
    for row in range(PARITY):
        mask = np.uint64(sum(1 << i for i in range(BITS) if (i + 1) >> row & 1))
        out |= (np.bitwise_count(words & mask) & 1).astype(np.int64) << row
    return out


def error_patterns(radius: int) -> list[np.ndarray]:
    """Per syndrome, the patterns of at most ``radius`` bits that have it; the leader first."""
    found: dict[int, list[int]] = {s: [] for s in range(1 << PARITY)}
    level = [(0, 0, -1)]
    for weight in range(radius + 1):
        for pattern, syndrome, _ in level:
            found[syndrome].append(pattern)
        level = [
            (p | 1 << i, s ^ (i + 1), i) for p, s, last in level for i in range(last + 1, BITS)
        ] if weight < radius else []
    return [np.array(found[s], dtype=np.uint64) for s in range(1 << PARITY)]


def anchor_rows(fp: np.ndarray, threshold: int, split: dict[tuple[int, int], int]):
    """Arrays ``anchor, part, visitor, fp``; the home row of a half has ``visitor`` 0."""
    patterns = error_patterns(1 + threshold)
    out: list[tuple[np.ndarray, ...]] = []
    for half, words in enumerate(_halves(fp)):
        syndromes = _syndrome(words)
        for s, errors in enumerate(patterns):
            at = np.flatnonzero(syndromes == s)
            if not len(at):
                continue
            anchors = ((words[at, None] ^ errors[None, :]) | np.uint64(half << BITS)).astype(np.int64)
            visitor = np.ones(anchors.shape, dtype=np.int8)
            visitor[:, 0] = 0
            out.append((anchors.ravel(), np.repeat(fp[at], len(errors)), visitor.ravel()))
    if not out:
        return [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int8), np.zeros(0, np.int64)]
    anchor, prints, visitor = (np.concatenate(x) for x in zip(*out))
    parts = np.zeros(len(anchor), dtype=np.int32)
    if split:
        hot = np.array(sorted(split), dtype=np.int64)
        n = np.array([split[h] for h in hot.tolist()], dtype=np.int64)
        place = np.searchsorted(hot, anchor).clip(0, len(hot) - 1)
        copies = np.where(hot[place] == anchor, n[place], 1)
        home = visitor == 0
        times = copies.copy()  # a home is also a visitor of the other parts
        rows = np.repeat(np.arange(len(anchor)), times)
        part = np.arange(len(rows)) - np.repeat(segments(times)[:-1], times)
        own = (prints.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % copies
        visitor = np.where(home[rows] & (own[rows] == part), 0, 1).astype(np.int8)
        anchor, prints, parts = anchor[rows], prints[rows], part.astype(np.int32)
    return [anchor, parts, visitor, prints]


def _near(homes: np.ndarray, visitors: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs at most ``distance`` bits apart, in blocks of bounded size."""
    a, b = [], []
    step = max(1, (1 << 22) // max(1, len(visitors)))
    for low in range(0, len(homes), step):
        x, y = np.nonzero(np.bitwise_count(homes[low : low + step, None] ^ visitors[None, :]) <= distance)
        pairs = forest(homes[low + x], visitors[y])
        a.append(pairs[0])
        b.append(pairs[1])
    return np.concatenate(a), np.concatenate(b)


def _links(groups, distance: int):
    """Link homes with members, group by group, from batches sorted by group."""
    carried: list[np.ndarray] | None = None
    streaming = 1 << 16

    def small(key, visitor, fp):
        a, b = [], []
        live = np.arange(len(key) - 1)
        shift = 1
        while len(live):
            live = live[live + shift < len(key)]
            live = live[key[live] == key[live + shift]]
            hit = live[
                ((visitor[live] == 0) | (visitor[live + shift] == 0))
                & (np.bitwise_count(fp[live] ^ fp[live + shift]) <= distance)
            ]
            a.append(fp[hit])
            b.append(fp[hit + shift])
            shift += 1
        return forest(np.concatenate(a), np.concatenate(b)) if a else None

    def group(key, visitor, fp):
        if len(key) < 2:
            return
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        large = sizes > 256
        rest = ~np.repeat(large, sizes)
        yield small(key[rest], visitor[rest], fp[rest])
        for start, size in zip(starts[large], sizes[large]):
            own, roles = fp[start : start + size], visitor[start : start + size]
            homes = own[roles == 0]
            for low in range(0, len(own), streaming):
                yield _near(homes, own[low : low + streaming], distance) if len(homes) else None

    def out(pairs):
        if pairs is not None and len(pairs[0]):
            yield pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)) for p in pairs], names=["a", "b"])

    for batch in groups:
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        new[2] = new[2].view(np.uint64)
        all_rows = new if carried is None else [np.concatenate(x) for x in zip(carried, new)]
        last = int(np.searchsorted(all_rows[0], all_rows[0][-1])) if len(all_rows[0]) else 0
        carried = [x[last:] for x in all_rows]
        for pairs in group(*[x[:last] for x in all_rows]):
            yield from out(pairs)
    if carried is not None:
        for pairs in group(*carried):
            yield from out(pairs)


def linked_fingerprints(prints: DataFrame, distance: int = 2, part_size: int = 1 << 15) -> DataFrame:
    """``fp`` and ``root``, the smallest fingerprint that can be reached, for every linked ``fp``.

    ``prints`` holds distinct fingerprints. Anchors with more than ``part_size`` homes (or a
    ten-thousandth of all fingerprints, if that is more) are split; there are at most 20 000 of
    them, so the list of them fits the closure at any size.
    """
    threshold = distance // 2
    spark = prints.sparkSession

    def replicate(split, homes_only=False):
        def run(batches):
            for batch in batches:
                fp = batch.column(0).to_numpy(zero_copy_only=False)
                for low in range(0, len(fp), 1 << 15):
                    anchor, part, visitor, own = anchor_rows(fp[low : low + (1 << 15)], threshold, split)
                    take = visitor == 0 if homes_only else slice(None)
                    group = anchor[take] << 20 | part[take]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(group), pa.array(visitor[take]), pa.array(own[take])], names=["g", "visitor", "fp"]
                    )

        return prints.select("fp").mapInArrow(run, "g long, visitor byte, fp long")

    limit = max(part_size, prints.count() // 10_000)
    crowded = replicate({}, homes_only=True).groupBy("g").count().where(F.col("count") > limit).collect()
    split = {row.g >> 20: int(row["count"] // limit + 1) for row in crowded}
    groups = replicate(split).repartition(shuffle_partitions(spark), "g").sortWithinPartitions("g", "visitor")
    edges = groups.mapInArrow(lambda batches: _links(batches, distance), "a long, b long")
    return components(materialise(edges.distinct(), "simhash-edges"))


def simhash_components(
    docs: DataFrame, key: Column, text: Column, length: int = 3, distance: int = 2
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row; ``component_id`` is the smallest reachable key."""
    prints = materialise(fingerprint(docs, key, text, length), "simhash")
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = linked_fingerprints(first.select("fp"), distance)
    joined = first.join(roots, "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    joined = materialise(joined, "simhash-roots")
    smallest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    names = joined.join(smallest, "root").select("fp", "component_id")
    return prints.join(names, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 3, distance: int = 2) -> DataFrame:
    """One row per component, the one with the smallest key, with all columns of ``docs``.

    Rows without a key can't name their component and stay. Rows that repeat key and text give one row; of
    different texts under one key each one stays.
    """
    found = simhash_components(docs, F.col(f"`{key}`"), F.col(f"`{text}`"), length, distance)
    name, digest = free_name(docs, "__chosen"), free_name(docs, "__digest")
    chosen = found.where("doc_id = component_id").select(F.col("doc_id").alias(name)).distinct()
    kept = docs.join(chosen, F.col(f"`{key}`") == F.col(name), "left_semi")
    own = F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"), 256)
    kept = kept.withColumn(digest, own).dropDuplicates([key, digest]).drop(digest)
    return kept.unionByName(docs.where(F.col(f"`{key}`").isNull()))
