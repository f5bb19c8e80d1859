"""Quality classifier: a byte-level convolutional network in numpy.

Filters of ``WIDTH`` bytes run over the whole UTF-8 text; a filter's response is a sum of one
learned value per (place in the filter, byte). Responses are max-pooled over overlapping chunks of
``CHUNK`` bytes (one every ``STRIDE``; together they cover every byte), rectified, and combined by
their mean and their maximum over the chunks and a logistic layer into one probability.

The network is fitted on about ``sample`` labelled rows at most, chosen by hash of their key, whose
texts have at most ``longest`` characters. Only texts enter a score. Gradients flow through the
maxima, so a step touches one place per chunk and filter.

Defined cases: null and empty texts are scored as one filter's width of padding; texts of any
length are scored whole; rows that repeat are scored alike; without labels of both classes every
score is their mean (one half without any); null labels and null keys are not learned from; empty
tables give empty tables; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import Shared, hash_share, map_texts

WIDTH = 5
FILTERS = 16
CHUNK = 256
STRIDE = 192


def lay_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes with padding after each text; chunk starts and ends; the text of each chunk."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(r + b"\0" * WIDTH for r in raw), np.uint8)
    sizes = np.array([max(1, len(r)) for r in raw], dtype=np.int64)
    base = np.cumsum([0] + [len(r) + WIDTH for r in raw])[:-1]
    counts = np.maximum(1, -(-(sizes - CHUNK) // STRIDE) + 1)
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = base[owner] + nth * STRIDE
    return data, starts, np.minimum(starts + CHUNK, (base + sizes)[owner]), owner


class Network:
    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.filters = rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, dtype=np.float32)
        self.out = rng.normal(0, 0.1, 2 * FILTERS)
        self.shift = 0.0

    def responses(self, data: np.ndarray) -> np.ndarray:
        n = len(data) - WIDTH + 1
        total = self.filters[0].take(data[:n], axis=0)
        for k in range(1, WIDTH):
            total += self.filters[k].take(data[k : k + n], axis=0)
        return total

    def pooled(self, data, starts, ends) -> np.ndarray:
        """Maxima per chunk, in runs of chunks that lie close together."""
        out = np.empty((len(starts), FILTERS), dtype=np.float32)
        step = 256
        for low in range(0, len(starts), step):
            a, b = starts[low : low + step], ends[low : low + step]
            found = self.responses(data[a[0] : b.max() + WIDTH - 1])
            bounds = np.stack([a, b], axis=1).ravel() - a[0]
            bounds[-1] = min(bounds[-1], len(found))
            if bounds[-1] == len(found):
                bounds = bounds[:-1]
            out[low : low + step] = np.maximum.reduceat(found, bounds, axis=0)[::2]
        return out

    def combine(self, pooled: np.ndarray, owner: np.ndarray, n: int):
        active = np.maximum(pooled + self.bias, 0)
        first = np.searchsorted(owner, np.arange(n))
        counts = np.diff(np.append(first, len(owner)))
        mean = np.add.reduceat(active, first, axis=0) / counts[:, None]
        most = np.maximum.reduceat(active, first, axis=0)
        joined = np.concatenate([mean, most], axis=1).astype(np.float64)
        return active, counts, joined, 1 / (1 + np.exp(-(joined @ self.out + self.shift)))

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        data, starts, ends, owner = lay_out(texts)
        return self.combine(self.pooled(data, starts, ends), owner, len(texts))[3]

    def fit(self, texts: list[str], y: np.ndarray, epochs: int = 6, batch: int = 32, rate: float = 0.01, seed: int = 3):
        """Minimise the log loss by Adam."""
        rng = np.random.default_rng(seed)
        names = ("filters", "bias", "out", "shift")
        first = {n: np.zeros_like(np.asarray(getattr(self, n), dtype=np.float64)) for n in names}
        second = {n: np.zeros_like(first[n]) for n in names}
        self.shift = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(texts))
            for low in range(0, len(order), batch):
                own = order[low : low + batch]
                grads = self.gradients([texts[i] for i in own], y[own])
                step += 1
                for n in names:
                    g = grads[n]
                    first[n] = 0.9 * first[n] + 0.1 * g
                    second[n] = 0.99 * second[n] + 0.01 * g * g
                    change = rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-8)
                    now = getattr(self, n)
                    setattr(self, n, (now - change).astype(now.dtype) if isinstance(now, np.ndarray) else float(now - change))

    def gradients(self, texts: list[str], y: np.ndarray) -> dict[str, np.ndarray]:
        data, starts, ends, owner = lay_out(texts)
        found = self.responses(data)
        place = np.empty((len(starts), FILTERS), dtype=np.int64)
        for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
            place[i] = a + found[a : min(b, len(found))].argmax(axis=0)
        pooled = np.take_along_axis(found, place, axis=0)
        active, counts, joined, p = self.combine(pooled, owner, len(texts))
        error = (p - y) / len(texts)
        through_mean = (error / counts)[owner][:, None] * self.out[:FILTERS]
        most = joined[:, FILTERS:][owner]
        ties = np.zeros((len(texts), FILTERS))
        is_most = active == most.astype(active.dtype)
        np.add.at(ties, owner, is_most)
        through_most = is_most / np.maximum(ties, 1)[owner] * error[owner][:, None] * self.out[FILTERS:]
        back = (through_mean + through_most) * (active > 0)
        filters = 1e-5 * self.filters.astype(np.float64)
        column = np.broadcast_to(np.arange(FILTERS), place.shape)
        for k in range(WIDTH):
            np.add.at(filters[k], (data[place + k], column), back)
        return {"filters": filters, "bias": back.sum(axis=0), "out": joined.T @ error + 1e-4 * self.out, "shift": error.sum()}


def train(docs: DataFrame, key: Column, text: Column, labels: DataFrame, label_key: Column, label: Column,
          sample: int = 4000, longest: int = 20_000) -> Network | float:
    """The fitted network, or the labels' mean if there is nothing to tell apart.

    ``labels`` are the rows that may be learned from; equal ones count once. At most ``2 * sample`` texts
    reach the driver, chosen by hash, however many texts share an id.
    """
    rows = labels.select(label_key.alias("k"), label.cast("double").alias("y")).where("k is not null and y is not null").distinct()
    chosen = hash_share(rows, F.col("k"), sample, rows.count())  # about ``sample`` rows to broadcast
    texts = docs.select(key.alias("k"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    found = texts.where(F.length("text") <= longest).join(F.broadcast(chosen), "k")
    found = found.orderBy(F.xxhash64("k", "y", "text")).limit(2 * sample).collect()
    found.sort(key=lambda r: (r.k, r.y, r.text))
    y = np.array([r.y for r in found])
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    network = Network()
    network.fit([r.text for r in found], y)
    return network


def score(docs: DataFrame, key: Column, text: Column, model: Network | float) -> DataFrame:
    """``doc_id, score`` for every row."""
    fitted = isinstance(model, Network)
    shared = Shared(docs.sparkSession, model)

    def run(texts, rows):
        found = shared.value.score(texts) if fitted else [shared.value] * len(texts)
        return {"doc_id": rows.column(1), "score": found}

    return map_texts(docs, [text, key.cast("long").alias("doc_id")], run, "doc_id long, score double", limit=1 << 20)
