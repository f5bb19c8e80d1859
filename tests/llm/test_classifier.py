import random

import numpy as np
from pyspark.sql import functions as F
from text_cases import make_docs, odd_rows, prose  # noqa: F401 (fixtures)

from footfall.llm import byte_cnn as b


def labelled(n=300):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        good = rng.random() < 0.6
        text = prose(i, rng.randrange(5, 200))
        rows.append((i, text if good else " ".join(w + rng.choice(["###", "$$$"]) if rng.random() < 0.5 else w for w in text.split()), int(good)))
    return rows


def test_pooled_equals_a_plain_convolution():
    network = b.Network()
    texts = ["", "a", "é" * 40, prose(1, 300), "x" * b.CHUNK, "x" * (b.CHUNK + 1), prose(2, 2000)]
    data, starts, ends, owner = b.lay_out(texts)
    pooled = network.pooled(data, starts, ends)
    row = 0
    for text in texts:
        raw = text.encode() + b"\0" * b.WIDTH
        size = max(1, len(text.encode()))
        answers = np.array([sum(network.filters[k][raw[p + k]] for k in range(b.WIDTH)) for p in range(size)])
        covered = set()
        start = 0
        while True:
            end = min(start + b.CHUNK, size)
            assert np.allclose(pooled[row], answers[start:end].max(axis=0), atol=1e-5)
            covered |= set(range(start, end))
            row += 1
            if end == size:
                break
            start += b.STRIDE
        assert covered == set(range(size))  # chunks cover the whole text
    assert row == len(owner)


def test_gradients_equal_differences():
    network = b.Network()
    texts, y = [prose(i, 40) for i in range(4)], np.array([1.0, 0, 1, 0])

    def loss():
        p = network.score(texts)
        return -np.mean(np.log(np.where(y == 1, p, 1 - p)))

    grads = network.gradients(texts, y)
    grads["filters"] -= 1e-5 * network.filters
    grads["out"] -= 1e-4 * network.out
    for name in ("filters", "bias", "out"):
        value = getattr(network, name)
        at = np.unravel_index(np.abs(grads[name]).argmax(), value.shape)
        step, old = 1e-2, value[at]
        value[at] = old + step
        up = loss()
        value[at] = old - step
        down = loss()
        value[at] = old
        assert abs(grads[name][at] - (up - down) / (2 * step)) < 0.15 * abs(grads[name][at]) + 1e-4, name


def test_held_out_accuracy():
    rows = labelled(500)
    network = b.Network()
    network.fit([t for _, t, _ in rows[:350]], np.array([y for _, _, y in rows[:350]], dtype=float))
    p = network.score([t for _, t, _ in rows[350:]])
    truth = np.array([y for _, _, y in rows[350:]])
    assert ((p >= 0.5) == truth).mean() > 0.95


def test_tables(spark, make_docs, odd_rows):
    rows = labelled(120)
    docs = make_docs([(1000 + i, t) for i, t, _ in rows] + odd_rows)
    labels = spark.createDataFrame([(1000 + i, y, "x") for i, _, y in rows] + [(None, 1, "x"), (1, None, "x")], "doc_id long, quality int, text string")
    key, text = F.col("doc_id"), F.col("text")
    model = b.train(docs, key, text, labels, F.col("doc_id"), F.col("quality"), sample=100)
    out = b.score(docs, key, text, model).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    same = [r.score for r in out if r.doc_id in (6, 9)]
    assert max(same) - min(same) < 1e-6
    assert b.score(docs.limit(0), key, text, model).count() == 0
    none = b.train(docs, key, text, labels.limit(0), F.col("doc_id"), F.col("quality"))
    assert {r.score for r in b.score(docs, key, text, none).collect()} == {0.5}
    good = b.train(docs, key, text, labels.where("quality = 1"), F.col("doc_id"), F.col("quality"))
    assert good == 1.0
