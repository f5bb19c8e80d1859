import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from footfall.llm import turn_trie

COLUMNS = ("conv_id", "turn", "role", "text")
VALUES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows):
    """Every node by dictionaries over all prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r, t) for *_, r, _, t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(own.get(c - c % 100, [])[:h] + ts[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append((c, len(whole)))
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    found = {}
    for node in sorted(members, key=len, reverse=True):
        convs = members[node]
        leaves = sum(found[k][5] for k in children[node]) or 1
        saved = sum(found[k][6] for k in children[node]) + ((len(convs) - 1) * len(node[-1][1]) if node else 0)
        ends = ",".join(str(c) for c in sorted(c for c, n in convs if n == len(node)))
        found[node] = (
            min(convs)[0], len(node), min(members[node[:-1]])[0] if node else None, len(convs), len(children[node]),
            leaves, saved, hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(found.values(), key=str)


def run(spark, rows, partitions=3):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.select("*", *[F.lit("x").alias(c) for c in ("base", "node", "part", "seq", "depth", "salt")]).repartition(partitions)
    return sorted((tuple(r[c] for c in VALUES) for r in turn_trie.prefix_trie(table, *[F.col(c) for c in COLUMNS]).collect()), key=str)


def corpus(seed, convs=400, kinds=3):
    rng = random.Random(seed)
    texts = ["", "a", "bé", "ccc", "你好"]
    return [
        (c, t, rng.choice(["user", "system"][:kinds]), rng.choice(texts[:kinds]))
        for c in range(convs)
        for t in range(rng.choice([1, 1, 2, 3, 6, 9]))
    ]


@pytest.mark.parametrize("seed, rows, size", [(1, 1 << 16, 1 << 24), (2, 7, 1 << 24), (3, 1, 1 << 24), (4, 1 << 16, 100)])
def test_equals_dictionaries(spark, monkeypatch, seed, rows, size):
    monkeypatch.setattr(turn_trie, "BLOCK_ROWS", rows)
    monkeypatch.setattr(turn_trie, "BLOCK_BYTES", size)
    monkeypatch.setattr(turn_trie, "PIECE", 3)
    data = corpus(seed)
    assert run(spark, data) == plain(data)


def test_one_sequence_of_most_conversations(spark):
    """A group of copies reaches over all ranges."""
    same = [("user", "hello"), ("assistant", "good day"), ("user", "bye")]
    data = [(c, t, *turn) for c in range(0, 3000) for t, turn in enumerate(same)] + [(5000 + c, *r[1:]) for c, r in enumerate(corpus(5, 50))]
    assert run(spark, data) == plain(data)


def test_odd_rows(spark):
    data = [
        (None, 1, "user", "lost"), (0, None, None, None), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 1, "assistant", "b"),
        (3, 5, "user", "x" * 50000), (3, None, "user", "first"), (-150, 1, "user", "a"), (-100, 1, "user", "a"), (777, 1, None, "a"),
        (10**15, 0, "user", ""), (10**15 + 1, 0, "user", "\x00"), (801, 0, "u", "ser"), (802, 0, "us", "er"),
    ] + [(900, t, "user", str(t % 7)) for t in range(3000)]
    assert run(spark, data) == plain(data)


def test_turnless_conversations_only(spark):
    """Conversations whose few turns are replaced by an absent base are members of the root alone."""
    ids = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1]
    data = [(c, 0, "user", "gone") for c in ids]
    assert run(spark, data) == plain(data) and len(run(spark, data)) == 1


def test_empty_table(spark):
    assert run(spark, []) == []


def test_minima_find_extents():
    import numpy as np

    rng = np.random.default_rng(1)
    numbers = rng.integers(0, 5, 200)
    minima = turn_trie.Minima(numbers)
    at, least = rng.integers(0, 200, 300), rng.integers(0, 6, 300)
    right = [next((j for j in range(a, 200) if numbers[j] < x), 200) for a, x in zip(at, least)]
    left = [next((j for j in range(a, -1, -1) if numbers[j] < x), -1) for a, x in zip(at, least)]
    assert minima.rightward(at, least).tolist() == right
    assert minima.leftward(at, least).tolist() == left
