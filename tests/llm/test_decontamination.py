import random
import time

import numpy as np
from pyspark.sql import functions as F
from text_cases import make_docs, odd_rows, prose  # noqa: F401 (fixtures)

from footfall.llm import decontaminate as dc


def brute_edits(item, part):
    """Fewest edits between ``item`` and a substring of ``part``."""
    row = [0] * (len(part) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(part, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def edited(text, n, rng):
    out = list(text)
    for _ in range(n):
        i = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[i] = rng.choice("abcdefgh")
        elif kind == 1:
            del out[i]
        else:
            out.insert(i, rng.choice("abcdefgh"))
    return "".join(out)


def test_edit_distance_equals_the_full_matrix():
    rng = random.Random(1)
    for _ in range(200):
        item = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 14)))
        part = bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 20)))
        assert dc.edit_within(item, part, 99) == brute_edits(item, part)


def test_keys_equal_a_plain_walk():
    rng = np.random.default_rng(2)
    window, samples, codes, rounds = 16, 6, 5, 3
    windows = rng.integers(0, codes, (20, window)).astype(np.uint8)
    walks = dc.Walks(window, samples, 3, rounds, codes)
    steps = 3 * window
    for r, keys in enumerate(walks.keys(windows, 0, rounds)):
        again = np.random.default_rng([3, window, r])
        moves = again.integers(0, 2, size=(codes, steps), dtype=np.int8)
        moves[:, -1] = 1
        picked = again.choice(2 * window, size=samples, replace=False)
        weight = again.integers(-(1 << 31), 1 << 31, size=(codes + 1, samples), dtype=np.int64)
        for key, text in zip(keys.tolist(), windows):
            i, written = 0, []
            for t in range(steps):
                code = text[i] if i < window else codes
                written.append(code)
                if i < window:
                    i += moves[code, t]
            total = sum(int(weight[written[t], n]) for n, t in enumerate(picked))
            assert (key - total) % (1 << 32) == 0
    assert (walks.keys(windows, 1, 2) == walks.keys(windows, 0, rounds)[1:2]).all()


def brute(items, text, error=0.1, least=24):
    """Items whose edit distance to some part of the text is small, by the full matrix."""
    found = set()
    for i, item in items:
        if len(item) < least:
            if item and item == text:
                found.add(i)
        elif brute_edits(item, text) <= int(error * len(item)):
            found.add(i)
    return found


def index_of(items, error=0.1):
    own = [(i, dc.normal(t)) for i, t in items]
    return dc.Index(own, error, rounds=dc.rounds_of(dc.Index(own, error), 0.99, 7))


def test_small_corpus_equals_brute_force():
    """Every item against every text: copies, edited copies up to and beyond the limit, parts of items, and prose."""
    rng = random.Random(3)
    items = [(i, prose(i, rng.randrange(6, 22))) for i in range(12)] + [(20, "yes"), (21, "Yes, it is."), (22, "")]
    texts = [prose(100 + i, rng.randrange(0, 60)) for i in range(20)] + ["YES", "yes and no", "", "yes it is"]
    for i, t in items[:12]:
        for rate in (0, 0.03, 0.06, 0.12, 0.3):
            texts.append(f"{prose(200 + i, rng.randrange(0, 20))} {edited(t, int(rate * len(t)), rng)} {prose(300 + i, 10)}")
        texts.append(prose(400 + i, 20) + t[: len(t) // 2])
    index = index_of(items)
    expected = [brute(index.items + [(i, t) for t, own in index.whole.items() for i in own], dc.normal(t)) for t in texts]
    found = [{hit[0] for hit in hits} for hits in index.find([dc.normal(t) for t in texts])]
    lost = sum(len(e - f) for e, f in zip(expected, found))
    assert not any(f - e for e, f in zip(expected, found))  # nothing false
    assert lost <= 0.02 * sum(map(len, expected)) and sum(map(len, expected)) > 30


def test_recall_per_size_on_edited_prose():
    """At the limit of 10 % edits, 24 to 1 500 bytes of prose, with production parameters."""
    rng = random.Random(8)
    items, texts = [], []
    for size in (24, 30, 46, 63, 90, 127, 190, 255, 380, 511, 520, 900, 1500):
        for n in range(40):
            item = dc.normal(prose(size * 100 + n, size))[:size]
            items.append((len(items), item))
            part = edited(item.decode(), size // 10, rng).encode()
            texts.append(dc.normal(prose(7 * size + n, 12)) + part + dc.normal(prose(9 * size + n, 9)))
    index = dc.Index(items, rounds=dc.rounds_of(dc.Index(items), 0.99, 7))
    found = [any(hit[0] == i for hit in hits) for i, hits in enumerate(index.find(texts))]
    recall = np.array(found).reshape(-1, 40).mean(axis=1)
    assert (recall >= 0.9).all() and recall.mean() >= 0.97, recall


def test_piece_test_loses_nothing():
    """Any part within the limit has two different pieces of the item, whatever the edits."""
    rng = random.Random(4)
    items = [(i, dc.normal(prose(i, rng.randrange(5, 60)))) for i in range(60)]
    index = dc.Index(items)
    for _ in range(10):
        texts = [edited(t.decode(), int(0.1 * len(t)), rng).encode() for _, t in items]
        joined, starts = dc.joined_texts(texts)
        text, unit, _ = index.places(joined, starts)
        own = index.owner[unit] == text
        assert set(text[own].tolist()) == set(range(len(items)))


def test_repetitive_texts_take_linear_time():
    items = [(1, b"ab" * 60), (2, dc.normal(prose(5, 30)))]
    index = dc.Index(items, rounds=dc.rounds_of(dc.Index(items), 0.99, 7))
    start = time.perf_counter()
    found = index.find([b"ab" * 100_000, b"a" * 200_000, b"ab" * 20 + b"cd" * 80_000])
    assert time.perf_counter() - start < 20
    assert [[h[0] for h in hits] for hits in found] == [[1], [], []]


def test_near_texts_do_not_join():
    """An item that begins in one text and ends in the next stands in neither."""
    item = dc.normal(prose(1, 30))
    index = dc.Index([(1, item)], rounds=dc.rounds_of(dc.Index([(1, item)]), 0.99, 7))
    assert index.find([item[: len(item) // 2], item[len(item) // 2 :]]) == [[], []]
    assert index.find([b"", item, b""]) == [[], [(1, 0, 0)], []]


def test_tables(spark, make_docs, odd_rows):
    items = [(1, prose(6, 30)), (2, prose(6, 30)), (None, prose(77, 30)), (4, None), (5, ""), (6, "one"), (7, prose(78, 40))]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    docs = make_docs(odd_rows + [(50, prose(3) + prose(77, 30)), (51, "x " + prose(78, 40)), (52, "One!")])
    for block_chars in (1 << 20, 200):  # one block, several blocks
        found = dc.find_items(docs, F.col("doc_id"), F.col("text"), benchmark, F.col("item_id"), F.col("text"), block_chars=block_chars)
        pairs = sorted((str(r.doc_id), str(r.item_id)) for r in found.collect())
        holders = [(d, i) for d in ("6", "6", "7", "9") for i in ("1", "2")]
        assert pairs == sorted(holders + [("50", "None"), ("51", "7"), ("52", "6"), ("4", "6")])
        kept = dc.drop_contaminated(docs, benchmark, block_chars=block_chars)
        assert kept.columns == docs.columns
        assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "8", "None"]
    assert dc.drop_contaminated(docs.limit(0), benchmark).count() == 0
    assert dc.drop_contaminated(docs, benchmark.limit(0)).count() == docs.count()
