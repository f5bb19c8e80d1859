import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from text_cases import make_docs, odd_rows  # noqa: F401

from footfall.llm import periodic_runs as pr

COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(words[i] == words[i + q] for i in range(len(words) - q)))


def plain_runs(words):
    """All runs by comparing every pair of places a period apart."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and smallest_period(words[i : i + length]) == q:
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_digest(key, text):
    words = (text or "").encode().split()
    n = len(words)
    if key is not None and n:
        h = zlib.crc32(str(key).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = plain_runs(words)
    best = None
    for s, length, q in runs:
        if best is None or length * best[2] > best[1] * q or (length * best[2] == best[1] * q and (s, q) < (best[0], best[2])):
            best = (s, length, q)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *shown, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def periodic(rng, n, letters=2):
    """Words with repeats of repeats."""
    words = []
    while len(words) < n:
        unit = [rng.choice("abcdefgh"[:letters]) for _ in range(rng.randint(1, 6))]
        if rng.random() < 0.4 and words:
            unit = words[-rng.randint(1, 12) :]
        words += unit * rng.randint(1, 6)
    return words[:n]


@pytest.mark.parametrize("seed", range(30))
def test_runs_equal_all_pairs(seed):
    rng = random.Random(seed)
    texts = [periodic(rng, rng.choice([0, 1, 5, 6, 20, 60, 150]), rng.choice([1, 2, 3, 8])) for _ in range(12)]
    numbers, _ = pr.word_lists([" ".join(t) for t in texts])
    assert [[tuple(r) for r in own.tolist()] for own in pr.find_runs(numbers)] == [plain_runs(t) for t in texts]


def test_small_slices_give_the_same(monkeypatch):
    rng = random.Random(77)
    texts = [periodic(rng, 120, 2) for _ in range(5)]
    numbers, _ = pr.word_lists([" ".join(t) for t in texts])
    monkeypatch.setattr(pr, "SLICE", 5)
    assert [[tuple(r) for r in own.tolist()] for own in pr.find_runs(numbers)] == [plain_runs(t) for t in texts]


def test_extensions_equal_a_plain_walk():
    rng = random.Random(5)
    words = np.array([ord(w) - 97 for w in periodic(rng, 400, 2)] + [9], dtype=np.int64)
    grammar = pr.Grammar(words, 45)
    i = np.array([rng.randrange(399) for _ in range(500)])
    j = np.array([rng.randrange(a + 1, 400) for a in i])
    for leftward, step in ((False, 1), (True, -1)):
        expected = []
        for a, b in zip(i.tolist(), j.tolist()):
            n = 0
            while True:
                x, y = (a + n, b + n) if step > 0 else (a - 1 - n, b - 1 - n)
                if min(x, y) < 0 or max(x, y) >= len(words) or words[x] != words[y]:
                    break
                n += 1
            expected.append(n)
        assert grammar.extend(i, j, leftward).tolist() == expected


def test_one_word_many_times():
    numbers, _ = pr.word_lists(["go " * 50000 + "x " + "to fro " * 30000])
    assert [r.tolist() for r in pr.find_runs(numbers)] == [[[0, 50000, 1], [50001, 60000, 2]]]


def test_digest_equals_plain(spark, make_docs, odd_rows):
    rng = random.Random(9)
    rows = [(i, t) for i, t in odd_rows if i != 7]
    rows += [(20 + i, " \n".join(periodic(rng, rng.choice([30, 90]), rng.choice([2, 8])))) for i in range(60)]
    rows += [(i, "one two three four five " * 6) for i in range(100, 140)]
    found = pr.digest(make_docs(rows), F.col("doc_id"), F.col("text")).collect()
    expected = [(i, *plain_digest(i, t)) for i, t in rows]
    assert sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in found), key=str) == sorted(expected, key=str)


def test_detect_lists_runs_and_collapses(make_docs):
    rows = [(1, "a b a b a b a b c"), (2, None), (3, "no repeats here")]
    found = {r.doc_id: r for r in pr.detect(make_docs(rows), F.col("doc_id"), F.col("text")).collect()}
    assert [tuple(x) for x in found[1].runs] == [(0, 8, 2)] and found[1].collapsed == "a b c"
    assert found[2].runs == [] and found[2].collapsed == "" and found[3].collapsed == "no repeats here"


def test_empty_table(make_docs):
    docs = make_docs([(1, "x")]).limit(0)
    assert pr.digest(docs, F.col("doc_id"), F.col("text")).count() == 0
