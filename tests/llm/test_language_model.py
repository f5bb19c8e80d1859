import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from text_cases import make_docs, odd_rows, prose  # noqa: F401 (fixtures)

from footfall.llm import gru_lm as g
from footfall.llm.common import crc_fold


def words_of(text):
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def counts():
    rng = np.random.default_rng(1)
    c = np.sort(rng.integers(1, 50, g.FREQUENT))[::-1].copy()
    kinds = np.concatenate([c.reshape(g.FULL, g.SLOTS).sum(axis=1), rng.integers(1, 90, g.RARE), [40]])
    return c, kinds


def random_ids(seed, n=9, most=40):
    rng = np.random.default_rng(seed)
    return [np.append(rng.integers(0, g.END, rng.integers(0, most)), g.END).astype(np.int32) for _ in range(n)]


def plain_score(network, ids):
    """One text, one token at a time, in double precision."""
    w = {n: v.astype(np.float64) for n, v in network.w.items()}
    h, total, before, size = np.zeros(g.HIDDEN), 0.0, g.END, g.HIDDEN
    bend = lambda a: a / (1 + np.abs(a))
    for i in ids.tolist():
        x, u = w["inputs"][before] + w["shift"], h @ w["turn"]
        gates = 0.5 + 0.5 * bend(x[: 2 * size] + u[: 2 * size])
        new = bend(x[2 * size :] + gates[size:] * u[2 * size :])
        h = new + gates[:size] * (h - new)
        logits = h @ w["to_class"] + w["class_shift"]
        kind = i // g.SLOTS if i < g.FREQUENT else i - g.FREQUENT + g.FULL
        total += logits[kind] - np.log(np.exp(logits).sum())
        if i < g.FREQUENT:
            logits = h @ w["to_word"][kind] + w["word_shift"][kind]
            total += logits[i % g.SLOTS] - np.log(np.exp(logits).sum())
        before = i
    return total / math.log(10)


def test_scores_equal_a_plain_network(counts):
    network = g.Network.start(*counts)
    network.w["turn"] *= 8
    ids = random_ids(2) + random_ids(3, n=2, most=400)  # state crosses several windows
    assert np.allclose(g.score_ids(network, ids), [plain_score(network, i) for i in ids], rtol=1e-4)
    assert g.score_ids(network, []).tolist() == []


def test_gradients_equal_differences(counts):
    network = g.Network.start(*counts)
    streams = g.Streams(random_ids(4, n=6, most=20), 4)
    own, widths = next(streams.windows(g.WINDOW))
    start = np.zeros((g.HIDDEN, streams.widths[0]), dtype=np.float32)

    def loss():
        states, _, _ = network.forward(streams.before[own], start, widths, keep=False)
        return -network.outputs(states, streams.target[own], grad=False).astype(np.float64).sum()

    states, _, trace = network.forward(streams.before[own], start, widths, keep=True)
    _, grads, back = network.outputs(states, streams.target[own], grad=True)
    grads |= network.backward(streams.before[own], widths, trace, back)
    for name in g.SHAPES:
        at = np.unravel_index(np.abs(grads[name]).argmax(), g.SHAPES[name])
        values = []
        for step in (1e-2, -2e-2):
            network.w[name][at] += np.float32(step)
            values.append(loss())
        network.w[name][at] += np.float32(1e-2)
        assert math.isclose(grads[name][at], (values[0] - values[1]) / 2e-2, rel_tol=0.03, abs_tol=2e-3), name


def test_training_helps(counts):
    network = g.Network.start(*counts)
    pattern = np.array([3, 77, 140, 9, g.FREQUENT + 2] * 30 + [g.END], dtype=np.int32)
    before = g.score_ids(network, [pattern])[0]
    trainer = g.Trainer(network)
    for _ in range(40):
        trainer.learn([pattern] * 20)
    assert g.score_ids(network, [pattern])[0] > 0.5 * before


def test_probabilities_sum_to_one(counts):
    """Over all words of a class with the unseen part, and over classes and slots."""
    network = g.Network.start(*counts)
    ids = [np.array([i, g.END], dtype=np.int32) for i in range(g.END + 1)]
    first = 10 ** (g.score_ids(network, ids) - [plain_score(network, i) - plain_score(network, i[:1]) for i in ids])
    assert math.isclose(first.sum(), 1, rel_tol=1e-3)


def test_rare_classes_agree(spark):
    words = ["a", "word", "wörd", "abcdefghij", "abcdefghijklm", "x9", "end.", "naïveté", "zz{", "AKIA", "你好", "é"]
    found = spark.createDataFrame([(w,) for w in words], "w string").select("w", g.rare_class_of(F.col("w")).alias("c"))
    assert {r.w: r.c for r in found.collect()} == {w: g.rare_class(w.encode()) for w in words}


def test_base_score(make_docs, odd_rows):
    rows = odd_rows + [(100 + i, prose(i, 50) + f" only{i}") for i in range(40)] + [(200, " ".join(["many"] * 70_000))]
    out = g.score(make_docs(rows), F.col("doc_id"), F.col("text"), crc_fold(F.col("doc_id")) == 1).collect()
    assert len(out) == len(rows)
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    c, ends = Counter(), 0
    for i, t in rows:
        if not held(i):
            c.update(words_of(t))
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    chance = lambda k: math.log10((k + 0.5) / (n + 0.5 * (v + 1)))
    expected = {}
    for i, t in rows:
        words = words_of(t)
        base = sum(chance(c[w]) for w in words) + chance(ends)
        expected.setdefault(i, []).append((held(i), len(words) + 1, sum(c[w] > 0 for w in words) + 1, n, base))
    for r in out:
        known = expected[r.doc_id][0]
        assert tuple(r)[1:5] == known[:4]
        assert math.isclose(r.base_score, known[4], rel_tol=1e-9)
        assert math.isfinite(r.score) and r.score < 0


def test_empty_and_untrained_tables(make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    assert g.score(docs.limit(0), F.col("doc_id"), F.col("text"), F.lit(False)).count() == 0
    out = g.score(docs, F.col("doc_id"), F.col("text"), F.lit(True)).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in out] == [(3, 0, 0), (1, 0, 0)]


def test_sums_of_many_batches(spark):
    """Entries of one piece that come in several batches are added, whatever their widths."""
    entries = [(5, [(0, 2), (700, 1)], 0.5), (5, [(3, 4)], 0.25), (6, [(1, 1)], 1.0), (5, [(700, 9)], 2.0)]
    rows = [(p, np.array([t << 16 | k for t, k in e], "<u4").tobytes(), b, 0.0, 1.0) for p, e, b in entries]
    table = spark.createDataFrame([(p, bytearray(e), b, s, k) for p, e, b, s, k in rows], "piece long, entries binary, base double, share double, known double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        out = g.sums_per_piece(table.coalesce(1)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = {r.piece: dict(zip(np.frombuffer(r.at, "<i4").tolist(), np.frombuffer(r.base).tolist())) for r in out}
    assert found == {5: {0: 1.0, 3: 1.0, 700: 18.5}, 6: {1: 1.0}}
