"""Words beyond the smallest model's frequent ones: buckets with vectors of their own."""

import math
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from text_cases import make_docs  # noqa: F401 (fixture)

from footfall.llm import gru_lm as g

FULL, BUCKETS = 16, 8 * 8


def network_with_buckets():
    rng = np.random.default_rng(5)
    counts = np.sort(rng.integers(1, 50, FULL * g.SLOTS))[::-1].copy()
    kinds = np.concatenate([counts.reshape(FULL, g.SLOTS).sum(axis=1), rng.integers(200, 400, g.RARE), [40]])
    network = g.Network.start(counts, kinds, buckets=rng.integers(1, 30, BUCKETS) + 0.5)
    for name in ("bucket_in", "bucket_out"):
        network.w[name][:] = rng.normal(0, 0.7, network.w[name].shape)
    network.sum_up()
    return network


def random_ids(network, n, most, seed=6):
    rng = np.random.default_rng(seed)
    known = np.concatenate([np.arange(network.frequent), network.end + 1 + np.arange(BUCKETS)])
    return [np.append(rng.choice(known, rng.integers(1, most)), network.end).astype(np.int32) for _ in range(n)]


def test_model_grows_with_the_vocabulary():
    sizes = [g.sizes_for(v) for v in (0, 50, 10_000, 400_000, 4_000_000, 10**9)]
    assert sizes[0] == (g.FREQUENT, 8 * g.RARE)
    assert sizes == sorted(sizes) and sizes[3] == (1024, 1 << 16) and sizes[4][0] == 2048
    assert sizes[2][1] > 1000


def test_words_of_one_rare_class_are_told_apart(spark):
    words = [f"w{i}é{i}a" for i in range(3000)] + ["a", "x9", "end.", "你好", "é", "abcdefghijklm"]
    ids = g.Ids([], 1024, 4096, most=100).of([w.encode() for w in words]) - (1024 + g.RARE + 1)
    assert len(set(ids.tolist())) > 500  # all share few classes; one class has 512 buckets
    found = spark.createDataFrame([(w,) for w in words], "w string").select("w", g.bucket_of(F.col("w"), 4096).alias("b")).collect()
    assert {r.w: r.b for r in found} == dict(zip(words, ids.tolist()))


def test_a_class_sums_to_one():
    """The parts of a class, times what the quadratic form leaves of them in any state."""
    network = network_with_buckets()
    classes = g.Network({n: network.w[n] for n in g.SHAPES})
    state = np.random.default_rng(8).uniform(-1, 1, g.HIDDEN).astype(np.float32)
    per = BUCKETS // g.RARE
    for r in range(g.RARE):
        ids = network.end + 1 + np.arange(r * per, (r + 1) * per)
        states = np.repeat(state[:, None], per, axis=1)
        only_class = classes.outputs(states, np.full(per, network.frequent + r), grad=False)
        own = np.exp(network.outputs(states, ids, grad=False) - only_class)
        assert own.std() > 0.1
        assert math.isclose((own * network.w["share"].reshape(g.RARE, per)[r]).sum(), 1, rel_tol=1e-4)


def test_bucket_gradients_equal_differences():
    network = network_with_buckets()
    streams = g.Streams(random_ids(network, 6, 30), 4, network.end)
    own, widths = next(streams.windows(g.WINDOW))
    before, target = streams.before[own], streams.target[own]
    start = np.zeros((g.HIDDEN, streams.widths[0]), dtype=np.float32)

    def loss():
        network.sum_up()
        states, _, _ = network.forward(before, start, widths, keep=False)
        return -network.outputs(states, target, grad=False).astype(np.float64).sum()

    states, _, trace = network.forward(before, start, widths, keep=True)
    _, grads, back = network.outputs(states, target, grad=True)
    grads |= network.backward(before, widths, trace, back)
    into = np.zeros_like(network.w["bucket_in"])
    into[grads["bucket_in"][0]] = grads["bucket_in"][1]
    bucket, own_part, sums, squares = grads["bucket_out"]
    out = sums[:, None] + network.w["bucket_out"].reshape(g.RARE, -1, g.HIDDEN) @ squares
    out = out.reshape(-1, g.HIDDEN) * network.w["share"][:, None]
    np.add.at(out, bucket, own_part)
    dense = {"bucket_in": into, "bucket_out": out} | {n: grads[n] for n in g.SHAPES}
    for name, grad in dense.items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        values = []
        for step in (1e-2, -2e-2):
            network.w[name][at] += np.float32(step)
            values.append(loss())
        network.w[name][at] += np.float32(1e-2)
        assert math.isclose(grad[at], (values[0] - values[1]) / 2e-2, rel_tol=0.03, abs_tol=5e-3), name


def test_numbers_and_words_travel():
    for numbers in ([], [0], [70_000, 3, 1 << 24, 255]):
        assert g.unpacked_numbers(g.packed_numbers(np.array(numbers, dtype=np.uint32))).tolist() == numbers
    assert [g.unpacked(g.packed(b)) for b in (b"", b"a b")] == [b"", b"a b"]


def test_pieces_end_at_rows_and_bytes():
    import pyarrow as pa

    rows = pa.RecordBatch.from_pydict({"text": ["abc", None, "de", "f" * 9, "g"], "doc_id": [1, 2, 3, 4, 5], "held_out": [True, False, False, True, False]})
    found = list(g.gathered([rows, rows], most=5, most_rows=3))
    assert [t for t, _, _ in found] == [[b"abc", b"", b"de"], [b"f" * 9], [b"g", b"abc", b""], [b"de"], [b"f" * 9], [b"g"]]
    assert [k for _, k, _ in found][2] == [5, 1, 2] and found[0][2] == [True, False, False]


def test_order_of_rare_words_is_learned(make_docs):  # noqa: F811
    """1 200 words alike in length and last character, each with one follower: only their own vectors can tell."""
    rng = np.random.default_rng(3)
    firsts, seconds = ([f"{c}{i:04d}x" for i in range(600)] for c in "fs")
    rows = []
    for i in range(600):
        at = rng.integers(0, 600, 150)
        rows.append((i, " ".join(f"{firsts[a]} {seconds[a]}" for a in at)))
    rows.append((600, " ".join(f"{firsts[a]} {seconds[a]}" for a in range(100))))
    rows.append((601, " ".join(f"{firsts[a]} {seconds[(7 * a + 300) % 600]}" for a in range(100))))
    out = g.score(make_docs(rows).coalesce(1), F.col("doc_id"), F.col("text"), F.col("doc_id") >= 600).collect()
    found = {r.doc_id: (r.score - r.base_score) / r.n_tokens for r in out if r.doc_id >= 600}
    assert found[600] > 0.05  # over the unigram model, log10 a token
    assert found[600] > found[601] + 0.1


def test_words_are_cut_and_numbered_by_first_sight():
    texts = [" B a\tb ", "", "\x0b\n", "É\x1cé a\x0c\x0dx\x85y", "  B"]
    expected = [t.encode().lower().split() for t in texts]
    codes, sizes, words = g.coded([t.encode() for t in texts])
    words = [w.encode() for w in words.to_pylist()]
    assert words == list(dict.fromkeys(w for own in expected for w in own))
    assert [words[c] for c in codes] == [w for own in expected for w in own] and sizes.tolist() == [len(own) for own in expected]
    codes, sizes, words = g.coded([b"", b" "])
    assert codes.tolist() == [] and sizes.tolist() == [0, 0] and words.to_pylist() == []


def test_only_rare_words_are_joined(make_docs, monkeypatch):  # noqa: F811
    """Entries of frequent words, most of all, must not be shuffled; one sum serves both scores."""
    joined, sums_per_piece = [], g.sums_per_piece
    monkeypatch.setattr(g, "sums_per_piece", lambda rows: joined.append(rows) or sums_per_piece(rows))
    rows = [(i, " ".join(f"often{k}" for k in range(256)) + f" seldom{i}") for i in range(30)]
    out = g.score(make_docs(rows), F.col("doc_id"), F.col("text"), F.lit(False)).collect()
    assert joined[0].columns == ["piece", "entries", "base", "known"]
    assert sum(len(r.entries) // 4 for r in joined[0].collect()) == 30
    n, v = 30 * 258, 256 + 30 + 1
    chance = lambda k: math.log10((k + 0.5) / (n + 0.5 * (v + 1)))
    for r in out:
        assert r.n_known == 258 and math.isclose(r.base_score, 257 * chance(30) + chance(1), rel_tol=1e-9)


def test_unseen_words_have_their_part_of_a_class(make_docs):  # noqa: F811
    """Without training texts a rare word's part is 0.5 of its class's mass, 0.5 for each of 8 buckets."""
    out = {r.doc_id: r.score for r in g.score(make_docs([(1, "aa"), (2, "")]), F.col("doc_id"), F.col("text"), F.lit(True)).collect()}
    network = g.Network.start(np.zeros(g.FREQUENT), np.zeros(g.FULL + g.RARE + 1), buckets=np.full(8 * g.RARE, 0.5))
    ids = [np.append(g.Ids([], g.FREQUENT, 8 * g.RARE).of([b"aa"]), network.end), np.array([network.end])]
    found = g.score_ids(network, ids)
    assert math.isclose(out[2], found[1], rel_tol=1e-5) and math.isclose(out[1], found[0] + math.log10(1 / 8), rel_tol=1e-5)


def test_words_and_entries_of_a_piece_are_counted_in_parts():
    texts = ["b a b", "", "c " * 70_000 + "a", "a d", " ", "d b"]
    data = [t.encode() for t in texts]
    whole, parts = g.coded(list(data)), g.coded(list(data), most=4)
    assert parts[0].tolist() == whole[0].tolist() and parts[1].tolist() == whole[1].tolist() == [3, 0, 70_001, 2, 0, 2]
    assert parts[2].to_pylist() == whole[2].to_pylist() == ["b", "a", "c", "d"]
    triples = [(0, 0, 2), (0, 5, 1), (1, 0, 1), (1, 2, 1), (1, 3, 1), (2, 2, 70_000 - 0xFFFF), (2, 2, 0xFFFF), (3, 3, 1), (3, 5, 1)]
    for most in (1, 3, 10**6):
        found = g.entries_of(parts[0], parts[1], most=most).tolist()
        assert [(x >> 32, x >> 16 & 0xFFFF, x & 0xFFFF) for x in found] == triples
    assert g.entries_of(*g.coded([b"", b" "])[:2]).tolist() == []


def test_memory_of_a_piece_is_a_few_times_its_bytes(monkeypatch):
    """Arrays and lists that a task makes beside its rows, Arrow's and numpy's peaks added."""
    rng = np.random.default_rng(4)
    words = [f"{c}{i}" for i in range(30_000) for c in "uvwxyz"]
    texts = [" ".join(words[i] for i in (rng.pareto(0.7, 600) * 20).astype(int) % len(words)) for _ in range(6000)]
    rows = pa.record_batch([pa.array(texts), pa.array(range(6000)), pa.array([False, True] * 3000)], ["text", "doc_id", "held_out"])
    size = sum(map(len, texts))
    del texts, words
    assert size < g.PIECE
    monkeypatch.setattr(g, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    run = g.postings(SimpleNamespace(mapInArrow=lambda function, schema: function))
    before, pool = pa.default_memory_pool(), pa.proxy_memory_pool(pa.default_memory_pool())
    pa.set_memory_pool(pool)
    tracemalloc.start()
    try:
        n = sum(sum(batch.column(2).drop_null().to_pylist()) for batch in run(iter([rows])))
        peak = pool.max_memory() + tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        pa.set_memory_pool(before)
    assert n == 3000 * 600
    assert peak < 10 * size, peak / size
