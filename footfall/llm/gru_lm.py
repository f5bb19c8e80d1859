"""Gated recurrent language model with a class-factored output over the whole counted vocabulary.

The network is a GRU whose gates and states bend by ``a / (1 + |a|)``, which numpy computes several
times as fast as exponentials.

The log probability of a word is that of its class given the recurrent state, plus that of the word
within its class. The most frequent training words lie in classes of ``SLOTS`` by rank, with a
softmax on the state; their number grows as the root of the vocabulary (``FREQUENT`` at least). All
other words lie in ``RARE`` classes told by length and last character, and there in buckets by hash,
whose number grows with the vocabulary up to ``BUCKETS``. A bucket has an input vector and an output
vector of its own: given its class, a word's probability goes with ``(c + 0.5) * (1 + x + x * x / 2)``,
``x`` being the product of state and output vector and ``c`` the word's training count. The sum over
all words of a class is then a quadratic form of the state, so it is exact at the same cost for any
vocabulary (one part of 0.5 stands for all unseen words of a bucket). The end of a text is a class
of its own.

In scoring the state is carried across windows through a whole text. In training it is carried
across windows of ``WINDOW`` steps, to which backpropagation is truncated, through spans of up to
``SPAN`` tokens; a longer text is learned from span by span. Texts run side by side. Every training text is learned from: each task trains from the same start on its share of
the corpus, and the weights are averaged by tokens, place by place; a bucket's vectors by the task's
tokens in it.

Word counts cover the whole training corpus. A piece of the corpus is cut into words once and
written as postings (word, texts of the piece with it, times) and as its words with the texts' word
numbers, which training and scoring read. Counts and postings meet in one join by word, and sums
come back per text, so no task or driver holds a vocabulary that grows. The frequent words, which make
up most entries, stay out of that join: every task has them with the model and sums them itself. A rare
word's part of its class is its base score plus a constant of the class, so one sum serves both scores.

Defined cases: null and empty texts are an end only; rows equal in key and text are scored alike, up
to the rounding of sums, and come back as often as given; a null key is a key of its own; without
training texts counts are zero and the model is the untrained one; empty tables give empty tables;
further columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from itertools import repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import CHUNK_BYTES, segments, texts_of
from footfall.session import materialise

FREQUENT = 256  # at least, and if no other number is given
SLOTS = 32
MOST_CLASSES = 128  # of frequent words
RARE = 8
BUCKETS = 1 << 16  # at most, of all rare classes; bounds the model that tasks hold
HIDDEN = 8
WINDOW = 32
SPAN = 1024
SCORED = 64  # steps of a window when nothing is learned
STREAMS = 1024  # at most side by side in scoring, fewer if the longest text would run alone
LEARNED = 400  # at most side by side in training
AT_ONCE = 4096  # tokens whose class probabilities lie in memory
OUT_EVERY = 4  # windows after which output vectors of buckets change
PIECE = 24 << 20  # text bytes of a piece, or one row
PIECE_ROWS = 1 << 15
ENTRIES = 1 << 18  # words or entries of a piece that are handled at once
BLOCK = 256  # buckets whose vectors travel together


# --- words ----------------------------------------------------------------------------------


def rare_class(word: bytes) -> int:
    """Class of a word that is not frequent: length and kind of the last character."""
    return int(rare_classes(len(word), word[-1]))


def rare_classes(sizes, last):
    return 2 * np.minimum(3, (sizes - 1) // 4) + ((last >= 97) & (last <= 122))


def rare_class_of(word: Column) -> Column:
    letter = F.right(word, F.lit(1)).between("a", "z").cast("int")
    return (2 * F.least(F.lit(3), F.floor((F.octet_length(word) - 1) / 4)) + letter).cast("int")


def bucket_of(word: Column, buckets: int) -> Column:
    per = buckets // RARE
    return rare_class_of(word) * per + F.crc32(word.cast("binary")) % per


def sizes_for(words: int) -> tuple[int, int]:
    """Frequent words and buckets of the model for a vocabulary of so many words; powers of two."""
    above = lambda x: 1 << max(0, int(np.ceil(np.log2(max(x, 1)))))
    frequent = SLOTS * min(MOST_CLASSES, above(words**0.5 / SLOTS))
    return max(FREQUENT, frequent), min(BUCKETS, max(8 * RARE, above(words / 8)))


class Ids(dict):
    """Id of a word in the model: rank of a frequent word, else the place of its bucket after the end."""

    def __init__(self, words: list[bytes], frequent: int, buckets: int, most: int = 1 << 16):
        super().__init__((w, i) for i, w in enumerate(words))
        self.most = most  # words handled at once
        self.first, self.per = frequent + RARE + 1, buckets // RARE

    def of(self, words: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.get, words, repeat(-1)), np.int32, len(words))
        for low in range(0, len(words), self.most):
            rare = low + np.flatnonzero(found[low : low + self.most] < 0)
            own, n = [words[i] for i in rare.tolist()], len(rare)
            sizes, last = np.fromiter(map(len, own), np.int64, n), np.fromiter(map(itemgetter(-1), own), np.int64, n)
            hashes = np.fromiter(map(zlib.crc32, own), np.int64, n)
            found[rare] = self.first + rare_classes(sizes, last) * self.per + hashes % self.per
        return found


# --- the network ----------------------------------------------------------------------------

END = FREQUENT + RARE
HIGHEST = np.float32(60)  # of a logit, so that no exponential overflows
FULL = FREQUENT // SLOTS  # classes of frequent words


def shapes(full: int) -> dict[str, tuple[int, ...]]:
    """Shapes of the weights, without the buckets' vectors, by number of classes of frequent words."""
    return {
        "inputs": (full * SLOTS + RARE + 1, 3 * HIDDEN),
        "turn": (HIDDEN, 3 * HIDDEN),
        "shift": (3 * HIDDEN,),
        "to_class": (HIDDEN, full + RARE + 1),
        "class_shift": (full + RARE + 1,),
        "to_word": (full, HIDDEN, SLOTS),
        "word_shift": (full, SLOTS),
    }


SHAPES = shapes(FULL)


class Network:
    """Weights by name. Ids: frequent words by rank, rare classes, the end, buckets by class.

    ``share`` holds each bucket's part of its class's words; the parts of a class sum to one.
    """

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = {n: np.ascontiguousarray(v, dtype=np.float32) for n, v in weights.items()}
        self.full = len(self.w["word_shift"])
        self.frequent = self.full * SLOTS
        self.end = self.frequent + RARE
        self.per = len(self.w["share"]) // RARE if "share" in self.w else 0
        if self.per:
            self.sum_up()

    @classmethod
    def start(cls, counts: np.ndarray, classes: np.ndarray, seed: int = 17, buckets: np.ndarray | None = None) -> Network:
        """Random weights; the shifts give the unigram model of ``counts`` per frequent word and class.

        ``buckets`` holds the mass of each bucket, class by class; their vectors start at zero.
        """
        rng = np.random.default_rng(seed)
        full = len(counts) // SLOTS
        w = {n: rng.normal(0, 0.1, s) for n, s in shapes(full).items()}
        w["shift"][:] = 0
        w["class_shift"] = np.log(classes + 0.5) - np.log((classes + 0.5).sum())
        slots = counts.reshape(full, SLOTS).astype(np.float64)
        share = slots / np.maximum(slots.sum(axis=1, keepdims=True), 1)
        w["word_shift"] = np.where(slots > 0, np.log(np.maximum(share, 1e-30)), -1e4)
        w["to_class"] *= 0.1
        w["to_word"] *= 0.1
        if buckets is not None:
            own = buckets.reshape(RARE, -1)
            w["share"] = (own / own.sum(axis=1, keepdims=True)).ravel()
            w["bucket_in"], w["bucket_out"] = np.zeros((len(buckets), 3 * HIDDEN)), np.zeros((len(buckets), HIDDEN))
        return cls(w)

    def sum_up(self) -> None:
        """Per rare class the sums over its words that make up the quadratic form."""
        out = self.w["bucket_out"].reshape(RARE, self.per, HIDDEN)
        weighted = out * self.w["share"].reshape(RARE, self.per, 1)
        self.line = weighted.sum(axis=1)
        self.square = np.matmul(weighted.transpose(0, 2, 1), out)

    def base(self, ids: np.ndarray) -> np.ndarray:
        """Ids with rare classes in place of their buckets."""
        return np.where(ids > self.end, self.frequent + (ids - self.end - 1) // max(1, self.per), ids) if self.per else ids

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        ids = self.base(ids)
        return np.where(ids < self.frequent, ids // SLOTS, ids - self.frequent + self.full)

    def flat(self) -> np.ndarray:
        """All weights but the buckets'."""
        return np.concatenate([self.w[n].ravel() for n in SHAPES])

    def fill(self, flat: np.ndarray) -> None:
        at = 0
        for n in SHAPES:
            self.w[n][...] = flat[at : at + self.w[n].size].reshape(self.w[n].shape)
            at += self.w[n].size

    # Arrays of states and gradients have a row per feature and a column per token.

    def inputs(self, ids: np.ndarray) -> np.ndarray:
        """Input vectors with their shifts, one after another."""
        x = (self.w["inputs"] + self.w["shift"]).take(self.base(ids), axis=0)
        if self.per:
            rare = np.flatnonzero(ids > self.end)
            x[rare] += self.w["bucket_in"].take(ids[rare] - self.end - 1, axis=0)
        return x

    def forward(self, before: np.ndarray, h: np.ndarray, widths: list[int], keep: bool, vectors: np.ndarray | None = None):
        """States after each step of a window. ``before`` holds the previous ids, step after step;
        the first ``widths[t]`` streams are still running at step t. The state restarts after an end.
        ``vectors`` are the inputs of all ids, if at hand."""
        x = np.ascontiguousarray((self.inputs(before) if vectors is None else vectors.take(before, axis=0)).T)
        goes_on = (before != self.end).astype(np.float32)
        turn, n2 = np.ascontiguousarray(self.w["turn"].T), 2 * HIDDEN
        states, trace, at = [], ([], [], [], []), 0
        half = np.float32(0.5)
        for m in widths:
            own = slice(at, at + m)
            at += m
            h = h[:, :m] * goes_on[own]
            g = turn @ h
            gates = g[:n2] + x[:n2, own]
            gates /= np.abs(gates) + 1
            gates *= half
            gates += half
            new = gates[HIDDEN:] * g[n2:]
            new += x[n2:, own]
            new /= np.abs(new) + 1
            after = h - new
            after *= gates[:HIDDEN]
            after += new
            states.append(after)
            if keep:
                for kept, values in zip(trace, (h, g[n2:], gates, new)):
                    kept.append(values)
            h = after
        return np.concatenate(states, axis=1), h, [np.concatenate(kept, axis=1) for kept in trace if kept]

    def outputs(self, h: np.ndarray, ids: np.ndarray, grad: bool):
        """Natural log probabilities of ``ids`` after states ``h``, without the rare words' own parts of
        their classes; with ``grad`` also the loss's gradients."""
        kind = self.class_of(ids)
        order = np.argsort(kind.astype(np.int16), kind="stable")
        kind, ids = kind[order], ids[order]
        cuts = np.searchsorted(kind, np.arange(self.full + RARE + 1))
        state = np.ones((HIDDEN + 1, len(ids)), dtype=np.float32)  # the last row is for shifts
        h.take(order, axis=1, out=state[:-1], mode="clip")
        found = np.empty(len(ids), dtype=np.float32)
        back = np.empty(h.shape, dtype=np.float32) if grad else None
        to_class = np.vstack([self.w["to_class"], self.w["class_shift"]])
        to_word = np.concatenate([self.w["to_word"], self.w["word_shift"][:, None]], axis=1)
        grad_class, grad_word = np.zeros_like(to_class), np.zeros_like(to_word)
        for low in range(0, len(ids), AT_ONCE):
            own = slice(low, low + AT_ONCE)
            found[own], g, b = chosen(to_class, state[:, own], kind[own], grad)
            if grad:
                grad_class += g
                back[:, own] = b
        for c in np.flatnonzero(np.diff(cuts[: self.full + 1])).tolist():
            own = slice(cuts[c], cuts[c + 1])
            f, g, b = chosen(to_word[c], state[:, own], ids[own] - c * SLOTS, grad)
            found[own] += f
            if grad:
                grad_word[c] = g
                back[:, own] += b
        grads = {}
        if self.per:
            grads["bucket_out"] = self.rare_outputs(state[:-1], ids, cuts[self.full :], found, back)
        places = np.empty_like(order)
        places[order] = np.arange(len(order))
        if not grad:
            return found[places]
        grads |= {"to_class": grad_class[:-1], "class_shift": grad_class[-1], "to_word": grad_word[:, :-1], "word_shift": grad_word[:, -1]}
        return found[places], grads, back.take(places, axis=1)

    def rare_outputs(self, states, ids, cuts, found, back):
        """Add the buckets' part to ``found``, for tokens that lie class after class; with ``back`` also its
        gradients to that. Gives buckets, their gradients as targets, and sums for all buckets of each class."""
        own = slice(cuts[0], cuts[-1])
        bucket, state, cuts = ids[own] - self.end - 1, states[:, own], cuts - cuts[0]
        out = np.ascontiguousarray(self.w["bucket_out"].take(bucket, axis=0).T)
        slope = np.empty(state.shape, dtype=np.float32)  # of half the quadratic form
        for r in range(RARE):
            slope[:, cuts[r] : cuts[r + 1]] = self.square[r] @ state[:, cuts[r] : cuts[r + 1]]
        line = np.repeat(self.line.T, np.diff(cuts), axis=1)
        x = np.einsum("ij,ij->j", out, state)
        total = np.einsum("ij,ij->j", state, line + np.float32(0.5) * slope)
        total += 1
        x += 1
        rise = np.float32(0.5) * (x * x + 1)  # 1 + x + x * x / 2
        found[own] += np.log(rise / total)
        if back is None:
            return None
        x /= rise
        shared = state / total
        back[:, own] += (line + slope) / total - x * out
        sums = [shared[:, cuts[r] : cuts[r + 1]].sum(axis=1) for r in range(RARE)]
        squares = [shared[:, cuts[r] : cuts[r + 1]] @ state[:, cuts[r] : cuts[r + 1]].T for r in range(RARE)]
        return bucket, (-x * state).T, np.array(sums), np.array(squares)

    def backward(self, before, widths, trace, back) -> dict[str, np.ndarray]:
        """Gradients of the recurrent weights; ``back`` holds the outputs' gradients per state."""
        turn, n2 = self.w["turn"], 2 * HIDDEN
        h, gn, gates, new = trace
        goes_on = (before != self.end).astype(np.float32)
        z, r = gates[:HIDDEN], gates[HIDDEN:]
        slope = 1 - np.abs(2 * gates - 1)  # of the gate before it is halved
        slope *= slope
        slope *= np.float32(0.5)
        to_z = (h - new) * slope[:HIDDEN]
        to_r = gn * slope[HIDDEN:]
        to_new = 1 - np.abs(new)
        to_new *= to_new
        to_new *= 1 - z
        z = z * goes_on
        dx, dg = (np.empty((3 * HIDDEN, len(before)), dtype=np.float32) for _ in range(2))
        dh, at = np.zeros((HIDDEN, 0), dtype=np.float32), len(before)
        for m in widths[::-1]:
            own = slice(at - m, at)
            at -= m
            d = back[:, own]
            d[:, : dh.shape[1]] += dh
            np.multiply(d, to_z[:, own], out=dg[:HIDDEN, own])
            dnew = np.multiply(d, to_new[:, own], out=dx[n2:, own])
            np.multiply(dnew, to_r[:, own], out=dg[HIDDEN:n2, own])
            np.multiply(dnew, r[:, own], out=dg[n2:, own])
            dh = turn @ dg[:, own]
            dh *= goes_on[own]
            dh += d * z[:, own]
        dx[:n2] = dg[:n2]
        grad_turn = h @ dg.T
        grad_in = np.zeros_like(self.w["inputs"])
        used, sums = sums_of(before, dx)
        plain = np.searchsorted(used, self.end, side="right")
        grad_in[used[:plain]] = sums[:plain]
        grads = {"turn": grad_turn, "inputs": grad_in, "shift": dx.sum(axis=1)}
        if self.per:
            grads["bucket_in"] = bucket, sums = used[plain:] - self.end - 1, sums[plain:]
            used, sums = sums_of(bucket // self.per, sums.T)
            grad_in[self.frequent + used] += sums
        return grads


def chosen(weights: np.ndarray, state: np.ndarray, own: np.ndarray, grad: bool):
    """Log softmax at ``own``; the loss's gradients to the weights and to the state, if asked for."""
    p = weights.T @ state
    if np.abs(weights).sum(axis=0).max() > HIGHEST:  # states lie between -1 and 1
        np.minimum(p, HIGHEST, out=p)
    columns = np.arange(len(own))
    found = p[own, columns]
    np.exp(p, out=p)
    total = p.sum(axis=0)
    found -= np.log(total)
    if not grad:
        return found, None, None
    p[own, columns] -= total
    over = 1 / total
    # numpy multiplies these several times as fast with the long side first
    back = (p.T @ np.ascontiguousarray(weights[:-1].T)).T
    back *= over
    return found, (p @ (state * over).T).T, back


def sums_of(places: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different places in order, and for each a row of the sums of its columns of ``values``."""
    times = np.bincount(places)
    used = np.flatnonzero(times)
    times[used] = np.arange(len(used))
    number = times[places]
    sums = np.empty((len(used), len(values)), dtype=np.float32)
    for i, v in enumerate(values):
        sums[:, i] = np.bincount(number, weights=v, minlength=len(used))
    return used, sums


class Streams:
    """Texts laid one after another into streams of nearly equal length that run side by side.

    Arrays are laid out step after step; at each step the longer streams come first.
    """

    def __init__(self, ids: list[np.ndarray], most: int, end: int = END):
        total, longest = sum(map(len, ids)), max(map(len, ids), default=1)
        streams = max(64, min(most, total // longest))
        order = sorted(range(len(ids)), key=lambda i: -len(ids[i]))
        filled = [(0, j) for j in range(min(streams, len(ids)))]
        own: list[list[int]] = [[] for _ in filled]
        for i in order:
            size, j = filled[0]
            own[j].append(i)
            heapq.heapreplace(filled, (size + len(ids[i]), j))
        own.sort(key=lambda texts: -sum(len(ids[i]) for i in texts))
        lengths = np.array([sum(len(ids[i]) for i in texts) for texts in own], dtype=np.int64)
        steps = int(lengths[0]) if len(lengths) else 0
        self.widths = np.searchsorted(-lengths, -np.arange(steps), side="left")
        self.starts = np.concatenate([[0], np.cumsum(self.widths)])
        self.target, self.before, self.owner = (np.empty(self.starts[-1], dtype=np.int32) for _ in range(3))
        for j, texts in enumerate(own):
            at = self.starts[: lengths[j]] + j
            flat = np.concatenate([ids[i] for i in texts])
            self.target[at] = flat
            self.before[at] = np.concatenate([[end], flat[:-1]])
            self.owner[at] = np.repeat(texts, [len(ids[i]) for i in texts])

    def windows(self, steps: int):
        """``(slice, widths)`` of each window."""
        for low in range(0, len(self.widths), steps):
            high = min(low + steps, len(self.widths))
            yield slice(int(self.starts[low]), int(self.starts[high])), self.widths[low:high].tolist()


def score_ids(network: Network, ids: list[np.ndarray]) -> np.ndarray:
    """log10 probability per text, without the rare words' own parts of their classes."""
    streams = Streams(ids, STREAMS, network.end)
    total = np.zeros(len(ids))
    h = np.zeros((HIDDEN, streams.widths[0] if len(ids) else 0), dtype=np.float32)
    vectors = network.inputs(np.arange(network.end + 1 + RARE * network.per))
    for own, widths in streams.windows(SCORED):
        states, h, _ = network.forward(streams.before[own], h, widths, keep=False, vectors=vectors)
        found = network.outputs(states, streams.target[own], grad=False)
        np.add.at(total, streams.owner[own].astype(np.int64), found.astype(np.float64))
    return total / np.log(10)


class Trainer:
    """Adagrad over windows; vectors of buckets by the sums, not the means, of their gradients."""

    def __init__(self, network: Network, rate: float = 0.2, bucket_rate: float = 0.3):
        self.network, self.rate, self.bucket_rate, self.tokens = network, rate, bucket_rate, 0
        self.squares = {n: np.full(network.w[n].shape, 1e-8, dtype=np.float32) for n in SHAPES}
        if network.per:
            self.squares |= {n: np.ones(network.w[n].shape, dtype=np.float32) for n in ("bucket_in", "bucket_out")}
            self.seen = np.zeros(len(network.w["share"]), dtype=np.int64)  # tokens in each bucket

    def learn(self, ids: list[np.ndarray]) -> None:
        w, end = self.network.w, self.network.end
        streams = Streams([i[low : low + SPAN] for i in ids for low in range(0, len(i), SPAN)], LEARNED, end)
        h = np.zeros((HIDDEN, streams.widths[0] if len(ids) else 0), dtype=np.float32)
        held = []
        for own, widths in streams.windows(WINDOW):
            before = streams.before[own]
            states, h, trace = self.network.forward(before, h, widths, keep=True)
            _, grads, back = self.network.outputs(states, streams.target[own], grad=True)
            grads |= self.network.backward(before, widths, trace, back)
            scale = np.float32(1.0 / (WINDOW * streams.widths[0]))  # a window with few streams weighs little
            for n in SHAPES:
                g = grads[n] * scale
                self.squares[n] += g * g
                g /= np.sqrt(self.squares[n])
                g *= np.float32(self.rate)
                w[n] -= g
            if self.network.per:
                rows, g = grads["bucket_in"]
                self.squares["bucket_in"][rows] += g * g
                w["bucket_in"][rows] -= np.float32(self.bucket_rate) * g / np.sqrt(self.squares["bucket_in"][rows])
                held.append(grads["bucket_out"])
                if len(held) == OUT_EVERY:
                    self.change_outputs(held)
                    held = []
            self.tokens += len(before)
        if held:
            self.change_outputs(held)
        if self.network.per:
            places = streams.target[streams.target > end] - end - 1
            self.seen += np.bincount(places, minlength=len(self.seen))

    def change_outputs(self, held: list) -> None:
        net = self.network
        out, squares = net.w["bucket_out"], self.squares["bucket_out"]
        sums, quads = sum(s for _, _, s, _ in held), sum(q for _, _, _, q in held)
        g = np.matmul(out.reshape(RARE, net.per, HIDDEN), quads)
        g += sums[:, None, :]
        g = g.reshape(out.shape)
        g *= net.w["share"][:, None]
        rows, own = sums_of(np.concatenate([b for b, *_ in held]), np.concatenate([x.T for _, x, *_ in held], axis=1))
        g[rows] += own
        squares += g * g
        g /= np.sqrt(squares)
        g *= np.float32(self.bucket_rate)
        out -= g
        net.sum_up()


# --- the corpus -----------------------------------------------------------------------------


def rows_of(docs: DataFrame, key: Column, text: Column, held_out: Column) -> DataFrame:
    body = F.coalesce(text.cast("string"), F.lit(""))
    return docs.select(body.alias("text"), key.cast("long").alias("doc_id"), held_out.alias("held_out"))


def packed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def packed_numbers(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, first all their lowest bytes, and so on."""
    return packed(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked_numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unpacked(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def gathered(batches, most: int = PIECE, most_rows: int = PIECE_ROWS):
    """Texts, keys and marks of a piece: whole batches or parts of them up to ``most`` bytes, or one row."""
    texts, keys, held, size = [], [], [], 0
    for batch in (b.slice(low, 512) for b in batches for low in range(0, b.num_rows, 512)):
        for text, key, mark in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            data = text.encode()
            if texts and (size + len(data) > most or len(texts) == most_rows):
                yield texts, keys, held
                texts, keys, held, size = [], [], [], 0
            texts.append(data)
            keys.append(key)
            held.append(bool(mark))
            size += len(data)
    if texts:
        yield texts, keys, held


def coded(texts: list[bytes], most: int = CHUNK_BYTES) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """Numbers of all words in order of first sight, the texts' numbers of words, and the different words.

    ``texts`` is emptied: ``most`` bytes, or one text, are cut at once.
    """
    sizes, parts = [], []
    texts.reverse()
    while texts or not parts:
        own, room = [], most
        while texts and (not own or len(texts[-1]) <= room):
            room -= len(texts[-1])
            own.append(texts.pop())
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(own, pa.string())))  # ASCII letters and ASCII white space only
        words = lists.flatten()
        real = pc.greater(pc.binary_length(words), 0)  # white space at an end of a text leaves an empty word
        sizes.append(np.diff(segments(real.to_numpy(zero_copy_only=False))[lists.offsets.to_numpy()]))
        del lists
        parts.append(words.filter(real).dictionary_encode())
        del words
    parts = pa.chunked_array(parts).unify_dictionaries().chunks
    codes = np.concatenate([p.indices.to_numpy() for p in parts])
    return codes.view(np.uint32), np.concatenate(sizes), parts[-1].dictionary


def stretches(ends: np.ndarray, most: int):
    """``(low, high)`` of neighbouring segments that hold ``most`` together, or one."""
    low = 0
    while low < len(ends) - 1:
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + most, side="right")) - 1)
        yield low, high
        low = high


def entries_of(codes: np.ndarray, sizes: np.ndarray, most: int = ENTRIES) -> np.ndarray:
    """``word << 32 | text << 16 | times`` in order; a time that takes more than 16 bits fills several."""
    ends, found, n = segments(sizes), np.empty(len(codes), dtype=np.uint64), 0
    for low, high in stretches(ends, most):
        pair = codes[ends[low] : ends[high]].astype(np.uint64) << 32
        pair |= np.repeat(np.arange(low, high, dtype=np.uint64) << 16, sizes[low:high])
        pair, times = np.unique(pair, return_counts=True)
        more = -(-times // 0xFFFF)
        pair, left = np.repeat(pair, more), np.minimum(np.repeat(times, more), 0xFFFF)
        left[np.cumsum(more) - 1] = times - 0xFFFF * (more - 1)
        found[n : n + len(pair)] = pair | left.astype(np.uint64)
        n += len(pair)
    found = found[:n]
    found.sort()
    return found


POSTINGS = "piece long, word string, n_train long, entries binary, doc_ids array<bigint>, held array<boolean>, sizes array<bigint>, words binary, codes binary"


def postings(rows: DataFrame) -> DataFrame:
    """Per piece one row of its texts, and a row per word; an entry is ``text << 16 | times``.

    The row of texts holds the piece's different words and, text after text, their numbers.
    """
    names = [c.split()[0] for c in POSTINGS.split(", ")]
    many = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), many, pa.list_(pa.bool_()), many, pa.binary(), pa.binary()]

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for part, keys, marks in gathered(batches):
            flat, sizes, listed = coded(part)
            n = len(listed)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), listed), " ")[0].as_buffer().to_pybytes()
            lists = [keys, marks, (sizes + 1).tolist(), packed(joined), packed_numbers(flat)]
            first = [pa.array([number]), *[pa.nulls(1, k) for k in kinds[1:4]]]
            yield pa.RecordBatch.from_arrays([*first, *[pa.array([v], k) for v, k in zip(lists, kinds[4:])]], names=names)
            del joined, lists
            found = entries_of(flat, sizes)
            del flat
            held = np.asarray(marks, dtype=bool)
            starts = np.searchsorted(found, np.arange(n + 1, dtype=np.uint64) << 32)
            for low, high in stretches(starts, ENTRIES):
                cuts = starts[low : high + 1] - starts[low]
                own = found[starts[low] : starts[high]].astype("<u4")
                train = np.add.reduceat(np.where(held[own >> 16], 0, own & 0xFFFF).astype(np.int64), cuts[:-1])
                binary = pa.Array.from_buffers(pa.binary(), high - low, [None, pa.py_buffer((4 * cuts).astype(np.int32).tobytes()), pa.py_buffer(own.tobytes())])
                piece = pa.array(np.full(high - low, number, dtype=np.int64))
                nulls = [pa.nulls(high - low, k) for k in kinds[4:]]
                yield pa.RecordBatch.from_arrays([piece, listed[low:high], pa.array(train), binary, *nulls], names=names)
            del found
            number += 1

    return rows.mapInArrow(run, POSTINGS)


def ids_of_pieces(batches, ids: Ids):
    """``piece, ids per text, held`` for rows ``piece, words, codes, held, sizes``."""
    for batch in batches:
        for r in range(batch.num_rows):
            piece, words, codes, held, sizes = (batch.column(c)[r].as_py() for c in range(5))
            cuts = segments(np.array(sizes, dtype=np.int64))
            word = np.ones(cuts[-1], dtype=bool)
            word[cuts[1:] - 1] = False
            flat = np.full(cuts[-1], ids.first - 1, dtype=np.int32)  # the end, where no word is
            flat[word] = ids.of(unpacked(words).split())[unpacked_numbers(codes)]
            del words, codes, word
            yield piece, [flat[a:b] for a, b in zip(cuts, cuts[1:])], held


def sums_row(piece: int, names: list[str], at: np.ndarray, values) -> pa.RecordBatch:
    blobs = [at.astype("<i4"), *[v.astype("<f8") for v in values]]
    return pa.RecordBatch.from_arrays([pa.array([piece]), *[pa.array([x.tobytes()], pa.binary()) for x in blobs]], names=["piece", "at", *names])


def sums_schema(names: list[str]) -> str:
    return "piece long, at binary, " + ", ".join(f"{n} binary" for n in names)


def sums_per_piece(joined: DataFrame) -> DataFrame:
    """Sums per text of each column after ``piece, entries``, combined within a task; texts whose first sum is zero are left out."""
    names = joined.columns[2:]

    def out(held):
        for piece, sums in held.items():
            at = np.flatnonzero(sums[0])
            yield sums_row(piece, names, at, [s[at] for s in sums])

    def run(batches):
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            piece = batch.column(0).to_numpy(zero_copy_only=False)
            blob = batch.column(1).combine_chunks() if isinstance(batch.column(1), pa.ChunkedArray) else batch.column(1)
            offsets = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1]
            flat = np.frombuffer(blob.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view("<u4")
            times = np.diff(offsets) // 4
            text, n = (flat >> 16).astype(np.int64), (flat & 0xFFFF).astype(np.float64)
            used, code = np.unique(piece, return_inverse=True)
            width = int(text.max()) + 1 if len(text) else 1
            cell = np.repeat(code, times) * width + text
            values = [np.bincount(cell, weights=n * np.repeat(batch.column(c).to_numpy(zero_copy_only=False), times), minlength=len(used) * width) for c in range(2, 2 + len(names))]
            for i, p in enumerate(used.tolist()):
                own = [v[i * width : (i + 1) * width] for v in values]
                if p not in held:
                    held[p] = own
                elif len(held[p][0]) >= width:
                    for a, b in zip(held[p], own):
                        a[:width] += b
                else:
                    for a, b in zip(own, held[p]):
                        a[: len(b)] += b
                    held[p] = own
            if sum(len(v[0]) for v in held.values()) > 1 << 21:
                yield from out(held)
                held = {}
        yield from out(held)

    return joined.mapInArrow(run, sums_schema(names))


def texts_from_sums(sums: DataFrame, texts: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, base, share`` per text; sums without ``share`` have it equal to ``base``."""
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, share double"
    empty = [F.lit(None).cast(k).alias(n) for n, k in (("doc_ids", "array<bigint>"), ("held", "array<boolean>"), ("sizes", "array<bigint>"))]
    blobs = [F.lit(None).cast("binary").alias(c) for c in ("at", "base", "known", "share")]
    rows = sums.select("*", *empty).unionByName(texts.select("piece", *blobs, "doc_ids", "held", "sizes"))

    def finish(table: pa.Table) -> pa.Table:
        own = table.to_pylist()
        head = next(r for r in own if r["doc_ids"] is not None)
        total = np.zeros((3, len(head["doc_ids"])))
        for r in own:
            if r["at"] is not None:
                at = np.frombuffer(r["at"], "<i4")
                for i, name in enumerate(("base", "known", "share")):
                    total[i, at] += np.frombuffer(r[name] if r[name] is not None else r["base"])
        return pa.table(
            {
                "doc_id": pa.array(head["doc_ids"], pa.int64()), "held_out": pa.array(head["held"], pa.bool_()),
                "n_tokens": pa.array(head["sizes"], pa.int64()), "n_known": np.rint(total[1]).astype(np.int64),
                "base": total[0], "share": total[2],
            }
        )

    return rows.groupBy("piece").applyInArrow(finish, schema)


LEARNT = "block long, places binary, n binary, w binary"


def learnt_blocks(trainer: Trainer):
    """Rows ``block, places, n, w``: weights, and vectors of the buckets that occurred; ``n`` are tokens."""
    names = [c.split()[0] for c in LEARNT.split(", ")]
    row = lambda block, places, n, w: pa.RecordBatch.from_arrays(
        [pa.array([block]), *[pa.array([x.tobytes()], pa.binary()) for x in (places.astype("<i4"), n.astype("<f8"), w.astype("<f4"))]], names=names
    )
    flat, net, size = trainer.network.flat(), trainer.network, 4 * HIDDEN * BLOCK
    for i in range(-(-len(flat) // size)):
        yield row(-1 - i, np.zeros(1), np.array([trainer.tokens]), flat[i * size : (i + 1) * size])
    for block in range(-(-len(trainer.seen) // BLOCK)):
        own = slice(block * BLOCK, (block + 1) * BLOCK)
        places = np.flatnonzero(trainer.seen[own])
        if len(places):
            both = np.hstack([net.w["bucket_in"][own], net.w["bucket_out"][own]])
            yield row(block, places, trainer.seen[own][places], both[places])


def mean_block(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    block = rows[0]["block"]
    total, weight = 0, np.zeros((BLOCK if block >= 0 else 1, 1))
    for r in rows:
        places, n = np.frombuffer(r["places"], "<i4"), np.frombuffer(r["n"])[:, None]
        w = np.frombuffer(r["w"], "<f4").reshape(len(places), -1)
        if isinstance(total, int):
            total = np.zeros((len(weight), w.shape[1]))
        total[places] += n * w
        weight[places] += n
    at = np.flatnonzero(weight)
    mean = (total[at] / weight[at]).astype("<f4")
    return pa.table({"block": [block], "places": [at.astype("<i4").tobytes()], "n": [weight[at].tobytes()], "w": [mean.tobytes()]}, schema=table.schema)


def train(texts: DataFrame, start: Network, frequent: list[bytes]) -> Network:
    """The mean of what the tasks learn from the training texts, weighted by tokens."""
    shared = texts.sparkSession.sparkContext.broadcast((start.w, frequent))

    def run(batches):
        weights, words = shared.value
        trainer = Trainer(Network({n: v.copy() for n, v in weights.items()}))
        ids = Ids(words, trainer.network.frequent, len(weights["share"]))
        for _, own, held in ids_of_pieces(batches, ids):
            trainer.learn([i for i, h in zip(own, held) if not h])
        if trainer.tokens:
            yield from learnt_blocks(trainer)

    learnt = texts.select("piece", "words", "codes", "held", "sizes").mapInArrow(run, LEARNT)
    # means of means: a group holds the blocks of a sixteenth of the tasks, then one block of each
    some = learnt.withColumn("part", F.spark_partition_id() % 16)
    partly = some.groupBy("block", "part").applyInArrow(lambda t: mean_block(t.drop_columns(["part"])), LEARNT)
    found = partly.groupBy("block").applyInArrow(mean_block, LEARNT).collect()
    if not found:
        return start
    network = Network({n: v.copy() for n, v in start.w.items()})
    network.fill(np.concatenate([np.frombuffer(r.w, "<f4") for r in sorted(found, key=lambda r: -r.block) if r.block < 0]))
    for r in found:
        if r.block >= 0:
            at = r.block * BLOCK + np.frombuffer(r.places, "<i4")
            both = np.frombuffer(r.w, "<f4").reshape(len(at), -1)
            network.w["bucket_in"][at], network.w["bucket_out"][at] = both[:, : 3 * HIDDEN], both[:, 3 * HIDDEN :]
    return network


def run_network(texts: DataFrame, network: Network, frequent: list[bytes], base: np.ndarray, lift: np.ndarray) -> DataFrame:
    """Sums per text of what a task knows without the join: ``base`` and ``known`` of the frequent words, and
    ``share``, the network's score with ``lift`` for every rare word of a class."""
    shared = texts.sparkSession.sparkContext.broadcast((network.w, frequent, base, lift))
    names = ["base", "known", "share"]

    def run(batches):
        weights, words, base, lift = shared.value
        network = Network(weights)
        ids = Ids(words, network.frequent, len(weights["share"]))
        none = np.zeros(RARE + 1)
        bases, lifts = np.concatenate([base, none, np.zeros(RARE * network.per)]), np.concatenate([0 * base, none, np.repeat(lift, network.per)])
        for piece, own, _ in ids_of_pieces(batches, ids):
            flat, starts = np.concatenate(own), segments(np.array([len(i) for i in own]))[:-1]
            columns = (bases.take, lambda i: (i < network.frequent).astype(np.float64), lifts.take)
            sums = [np.add.reduceat(column(flat), starts) for column in columns]
            del flat
            sums[2] += score_ids(network, own)
            yield sums_row(piece, names, np.arange(len(own)), sums)

    return texts.select("piece", "words", "codes", "held", "sizes").mapInArrow(run, sums_schema(names))


def score(docs: DataFrame, key: Column, text: Column, held_out: Column) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Rows for which ``held_out`` is true are scored but not learned from.
    """
    rows = rows_of(docs, key, text, held_out)
    written = materialise(postings(rows), "postings")
    words, texts = written.where("word is not null"), written.where("word is null")
    counted = words.where("n_train > 0").groupBy("word").agg(F.sum("n_train").alias("c"))
    counted = materialise(counted, "word-counts")
    ends = texts.select(F.aggregate("held", F.lit(0).cast("long"), lambda a, x: a + F.when(x, 0).otherwise(1)).alias("n")).agg(F.sum("n")).first()[0] or 0
    sums = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n, v = sums[0] + ends, sums[1] + (ends > 0)
    size, buckets = sizes_for(sums[1])
    top = counted.orderBy(F.desc("c"), "word").limit(size).collect()
    frequent = [r.word.encode() for r in top]
    listed = F.broadcast(docs.sparkSession.createDataFrame([(r.word, r.c) for r in top], "word string, c long"))  # the model's frequent words
    rare = counted.join(listed, "word", "left_anti").groupBy(bucket_of(F.col("word"), buckets).alias("bucket"))
    full = size // SLOTS
    held, masses = np.full(buckets, 0.5), np.zeros(buckets)
    for r in rare.agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        held[r.bucket] += r.c + 0.5 * r.v
        masses[r.bucket] = r.c
    counts, kinds = np.zeros(size, dtype=np.int64), np.zeros(full + RARE + 1)
    counts[: len(top)] = [r.c for r in top]
    kinds[:full] = counts.reshape(full, SLOTS).sum(axis=1)
    kinds[full : full + RARE], kinds[-1] = masses.reshape(RARE, -1).sum(axis=1), ends
    network = train(texts, Network.start(counts, kinds, buckets=held), frequent)

    unit = n + 0.5 * (v + 1)
    base = np.log10((counts + 0.5) / unit)
    lift = np.log10(unit / held.reshape(RARE, -1).sum(axis=1))  # a rare word's part of its class, over its base score
    c = F.coalesce("c", F.lit(0))
    joined = words.join(listed, "word", "left_anti").select("piece", "word", "entries").join(counted, "word", "left").select(
        "piece", "entries", F.log10((c + 0.5) / F.lit(unit)).alias("base"), (c > 0).cast("double").alias("known")
    )
    sums = sums_per_piece(joined).unionByName(run_network(texts, network, frequent, base, lift), allowMissingColumns=True)
    per_text = texts_from_sums(sums, texts)
    end = float(np.log10((ends + 0.5) / unit))
    return per_text.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + (1 if ends else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.lit(end)).alias("base_score"),
        F.col("share").alias("score"),
    )
