"""Secret scan: three fixed patterns, and a linear-chain CRF that tags tokens B, I or O.

A token is a run of the characters secrets are written in. Its features are its shape (which
character classes it has, how often they alternate, its length, its share of digits), the words
before it (a secret's name; whether ``:`` or ``=`` stands between) and two features of the file
(the share of lines that assign something, the share of long tokens). Each feature has few values,
so a token's scores are sums of small tables.

The CRF is fitted by maximum likelihood on at most ``sample`` documents, half of them with a match
of the patterns, whose spans serve as labels; names are hidden from half of the labelled secrets,
so that shape alone can carry one, and two thirds of them are learned in upper or mixed case too. Decoding is exact Viterbi: a token whose score for O leads by
more than any change of the transitions around it could return is O on the best path, and splits
the chain; only the stretches in between are searched, all of one length at once.

Spans are in code points, end exclusive. A tagged span counts as ``crf`` if it has at least
``MIN_CRF`` characters and touches no pattern's span.

Defined cases: null and empty texts have no spans; a table without a match of the patterns gives
pattern spans only (there is nothing to learn from); rows that repeat are scanned alike; empty
tables give empty tables; further columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import hash_share, map_texts

#: Fixed values of the contract: the three kinds, in the order they are listed.
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")  # a run of 24 or more: shorter runs would be dropped

MIN_CRF = 16
O, B, I = 0, 1, 2
NAMES = (b"pass", b"secret", b"token", b"key", b"credential", b"bearer", b"auth", b"private")
LONG = 12  # shorter tokens are told apart by length only


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the patterns' matches, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# --- tokens and features --------------------------------------------------------------------

CLASS = np.zeros(256, dtype=np.uint8)  # 0 outside a token
CLASS[list(b"abcdefghijklmnopqrstuvwxyz")] = 1
CLASS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 2
CLASS[list(b"0123456789")] = 3
CLASS[list(b"+/_.=-")] = 4
LENGTHS = np.array([4, 8, 12, 16, 20, 24, 32, 48])
SIZES = (16 * 9, 9 * 6, 9 * 5, 2 * 2 * 2, 9 * 8, 4, 4)  # values per feature
STARTS = np.concatenate([[0], np.cumsum(SIZES)])


def _share(part: np.ndarray, whole: np.ndarray, bounds: tuple[float, ...]) -> np.ndarray:
    return np.digitize(part / np.maximum(whole, 1), bounds)


def _starts_of_names(raw: bytes) -> np.ndarray:
    lower, found = raw.lower(), []
    for name in NAMES:
        at = lower.find(name)
        while at >= 0:
            found.append(at)
            at = lower.find(name, at + 1)
    return np.array(found, dtype=np.int64)


def tokens(raw: bytes, ends: np.ndarray):
    """Token bounds in ``raw``, their document, and a row of values per feature.

    ``ends`` are the ends of the documents that ``raw`` joins, each with a zero byte after it.
    """
    data = np.frombuffer(raw, np.uint8)
    kind = CLASS[data]
    edges = np.flatnonzero(np.diff((kind > 0).view(np.int8), prepend=0, append=0))
    a, b = edges[::2], edges[1::2]
    owner = np.searchsorted(ends, a, side="right")
    n, size = len(a), b - a
    if not n:
        return a, b, owner, np.zeros((len(SIZES), 0), dtype=np.int32)
    at = np.flatnonzero(size >= LONG)
    lengths = size[at]
    token = np.repeat(np.arange(len(at)), lengths)
    place = np.arange(len(token)) + np.repeat(a[at] - (np.cumsum(lengths) - lengths), lengths)
    kinds = kind[place]
    counts = np.bincount(token * 5 + kinds, minlength=5 * len(at)).reshape(-1, 5)
    turns = (kinds[1:] != kinds[:-1]) & (token[1:] == token[:-1])
    changes = np.bincount(token[1:][turns], minlength=len(at))
    length = np.digitize(size, LENGTHS)
    present, mixed, digits = (np.zeros(n, dtype=np.int64) for _ in range(3))
    present[at] = (counts[:, 1:] > 0) @ np.array([1, 2, 4, 8])
    mixed[at] = _share(changes, lengths, (0.05, 0.15, 0.3, 0.45, 0.6))
    digits[at] = _share(counts[:, 3], lengths, (0.01, 0.2, 0.5, 0.95))
    same = np.r_[False, owner[1:] == owner[:-1]]
    named = np.zeros(n, dtype=bool)
    hits = np.searchsorted(a, _starts_of_names(raw), side="right") - 1
    named[hits[hits >= 0]] = True
    before = same & np.r_[False, named[:-1]]
    before2 = same & np.r_[False, before[:-1]]
    marks = np.flatnonzero((data == ord(":")) | (data == ord("=")))
    near = np.flatnonzero((before | before2 | (size >= LONG)) & same)
    assigned = np.zeros(n, dtype=bool)
    assigned[near] = np.searchsorted(marks, a[near]) > np.searchsorted(marks, b[near - 1])
    single = (before2 | before) & (np.r_[0, size[:-1]] <= 1)  # "token = x": the sign is a token itself
    previous = np.r_[8, length[:-1]]
    previous[~same] = 8
    gap = np.r_[a[0], a[1:] - b[:-1]]

    def per_document(places):
        return np.bincount(np.searchsorted(ends, places, side="right"), minlength=len(ends) + 1)

    code = _share(per_document(marks), 1 + per_document(np.flatnonzero(data == 10)), (0.1, 0.5, 1.0))
    dense = _share(per_document(a[size >= 20]), np.bincount(owner, minlength=len(ends) + 1), (0.005, 0.05, 0.3))
    features = (
        present * 9 + length,
        length * 6 + mixed,
        length * 5 + digits,
        (before | before2) * 4 + assigned * 2 + single,
        previous * 8 + np.minimum(gap, 7),
        code[owner],
        dense[owner],
    )
    return a, b, owner, np.stack([f + s for f, s in zip(features, STARTS)]).astype(np.int32)


def label(a: np.ndarray, b: np.ndarray, secrets: list[tuple[int, int]]) -> np.ndarray:
    """B for the first token that lies in a secret, I for the further ones."""
    y = np.zeros(len(a), dtype=np.int8)
    for low, high in secrets:
        own = np.flatnonzero((a >= low) & (b <= high))
        y[own] = I
        y[own[:1]] = B
    return y


def secret_parts(text: str) -> list[tuple[int, int]]:
    """Byte spans of the secrets themselves, without the name before them."""
    found = [(m.start(1), m.end(1)) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [(a, b) for a, k, b in pattern_spans(text) if k]
    return [(len(text[:a].encode()), len(text[:b].encode())) for a, b in sorted(set(found))]


def recased(text: str, rng: np.random.Generator) -> str:
    """The text with its secrets in upper or mixed case, or as it is, with equal chances."""
    kind, parts, at = int(rng.integers(0, 3)), [], 0
    raw = text.encode()
    for low, high in secret_parts(text) if kind else ():
        if low < at:
            continue
        own = raw[low:high]
        flips = rng.random(len(own)) < (1.0 if kind == 1 else 0.5)
        own = bytes(c - 32 if f and 97 <= c <= 122 else c for c, f in zip(own, flips))
        parts += [raw[at:low], own]
        at = high
    return b"".join([*parts, raw[at:]]).decode()


# --- the model ------------------------------------------------------------------------------


def fit(texts: list[str], epochs: int = 80, rate: float = 0.1, decay: float = 1e-5, seed: int = 5):
    """Feature weights (feature value, label) and transitions (label, label), by Adam.

    Each training chain is a secret with the ``around`` tokens beside it, or as many tokens from a
    text without one; forward and backward sums run over all chains of a length at once.
    """
    around = 8
    rng = np.random.default_rng(seed)
    chains, labels = [], []
    variants = [(v, secret_parts(t)) for t in texts for v in dict.fromkeys((t, recased(t, rng)))]
    for text, secrets in variants:
        raw = text.encode() + b"\0"
        a, b, _, x = tokens(raw, np.array([len(raw)]))
        y = label(a, b, secrets)
        at = np.flatnonzero(y == B)
        if not len(at) and len(a):
            at = rng.integers(0, len(a), size=2)
        for i in at.tolist():
            low, high = max(0, i - around), min(len(a), i + around)
            own = x[:, low:high].T.copy()
            if rng.random() < 0.5:
                own[:, 3] = STARTS[3]  # no name, no sign
            chains.append(own)
            labels.append(y[low:high])
    weights, moves = np.zeros((STARTS[-1], 3)), np.zeros((3, 3))
    if not any((y > 0).any() for y in labels):
        return None
    by_length: dict[int, list[int]] = {}
    for i, x in enumerate(chains):
        by_length.setdefault(len(x), []).append(i)
    groups = [(np.stack([chains[i] for i in own]), np.stack([labels[i] for i in own])) for n, own in sorted(by_length.items()) if n]
    total = sum(x.shape[0] for x, _ in groups)
    held = [np.zeros_like(x) for x in (weights, weights, moves, moves)]  # means of gradients and squares
    for epoch in range(1, epochs + 1):
        grad_w, grad_m = -decay * weights, -decay * moves
        for x, y in groups:
            score = weights[x].sum(axis=2)
            node, edge = marginals(score, moves)
            node = (np.eye(3)[y] - node) / total
            for k in range(3):
                own = np.repeat(node[:, :, k].ravel(), x.shape[2])
                grad_w[:, k] += np.bincount(x.ravel(), weights=own, minlength=len(grad_w))
            seen = np.zeros((3, 3))
            np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
            grad_m = grad_m + (seen - edge) / total
        for i, (values, grad) in enumerate(((weights, grad_w), (moves, grad_m))):
            mean, square = held[2 * i], held[2 * i + 1]
            mean += 0.1 * (grad - mean)
            square += 0.01 * (grad**2 - square)
            step = mean / (1 - 0.9**epoch) / (np.sqrt(square / (1 - 0.99**epoch)) + 1e-12)
            values += rate * step
        np.clip(moves, -2.0, 2.0, out=moves)
    return weights, moves


def _sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(score: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of chains of one length, and expected transitions over all of them."""
    n = score.shape[1]
    ahead, behind = score.copy(), np.zeros_like(score)
    for t in range(1, n):
        ahead[:, t] += _sum(ahead[:, t - 1, :, None] + moves, axis=1)
    for t in range(n - 2, -1, -1):
        behind[:, t] = _sum(moves + (score[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
    z = _sum(ahead[:, -1], axis=1)
    node = np.exp(ahead + behind - z[:, None, None])
    edge = np.zeros((3, 3))
    for t in range(1, n):
        both = ahead[:, t - 1, :, None] + moves + (score[:, t] + behind[:, t])[:, None, :]
        edge += np.exp(both - z[:, None, None]).sum(axis=0)
    return node, edge


def lead_needed(moves: np.ndarray) -> float:
    """How much the transitions around a token can favour another label over O at most."""
    through = moves[:, :, None] + moves[None, :, :]  # before, here, after
    return float((through - through[:, [O], :]).max().clip(0)) + max(0.0, float((moves - moves[[O]]).max()), float((moves - moves[:, [O]]).max()))


def viterbi(score: np.ndarray, moves: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Best labels of consecutive tokens; ``breaks`` marks the first token of a document."""
    y = np.zeros(len(score), dtype=np.int8)
    open_ = score[:, O] - score[:, 1:].max(axis=1, initial=-np.inf) <= lead_needed(moves)
    at = np.flatnonzero(open_)
    if not len(at):
        return y
    # a stretch is a run of open tokens of one document; what stands beside it is O or a document's end
    first = np.r_[True, (np.diff(at) > 1) | breaks[at[1:]]]
    starts = at[first]
    lengths = np.diff(np.r_[np.flatnonzero(first), len(at)])
    after = starts + lengths
    bound_left = (~breaks[starts]).astype(float)
    bound_right = (after < len(score)) & ~np.r_[breaks, True][after]
    for n in np.unique(lengths):
        own = np.flatnonzero(lengths == n)
        rows = starts[own][:, None] + np.arange(n)
        s = score[rows]
        best = s[:, 0] + bound_left[own][:, None] * moves[O]
        back = np.zeros((len(own), n, 3), dtype=np.int8)
        for t in range(1, n):
            both = best[:, :, None] + moves
            back[:, t] = both.argmax(axis=1)
            best = both.max(axis=1) + s[:, t]
        best = best + bound_right[own][:, None] * moves[:, O]
        last = best.argmax(axis=1)
        for t in range(n - 1, -1, -1):
            y[rows[:, t]] = last
            last = back[np.arange(len(own)), t, last]
    return y


def tagged(texts: list[str], model) -> list[list[tuple[int, int]]]:
    """Spans that the CRF tags, per text, in code points."""
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    encoded = [t.encode() for t in texts]
    raw = b"\0".join(encoded) + b"\0"
    ends = np.cumsum([len(e) + 1 for e in encoded])
    a, b, owner, x = tokens(raw, ends)
    if model is None or not len(a):
        return out
    weights, moves = model
    score = np.zeros((len(a), 3))
    for f in range(len(SIZES)):
        score += weights.take(x[f], axis=0)
    y = viterbi(score, moves, np.r_[True, owner[1:] != owner[:-1]])
    hits = np.flatnonzero(y != O)
    if not len(hits):
        return out
    begins = (y[hits] == B) | np.r_[True, (np.diff(hits) > 1) | (owner[hits[1:]] != owner[hits[:-1]])]
    runs = np.split(hits, np.flatnonzero(begins)[1:])
    for run in runs:
        d = int(owner[run[0]])
        base = int(ends[d]) - len(encoded[d]) - 1
        low, high = int(a[run[0]]) - base, int(b[run[-1]]) - base
        start = len(encoded[d][:low].decode())
        out[d].append((start, start + len(encoded[d][low:high].decode())))
    return out


def spans(texts: list[str], model) -> list[tuple[list, list]]:
    """Per text, the patterns' spans and all spans."""
    out = []
    for text, own in zip(texts, tagged(texts, model)):
        base = pattern_spans(text)
        extra = [
            (a, 3, b) for a, b in own
            if b - a >= MIN_CRF and not any(a < high and low < b for low, _, high in base)
        ]
        out.append((base, sorted(base + extra)))
    return out


def train(docs: DataFrame, key: Column, text: Column, sample: int = 2000, longest: int = 20_000):
    """The fitted model, or None without any secret.

    The sample holds about ``sample`` documents, half with a match of the patterns, chosen by hash
    of key and text; texts of over ``longest`` characters are not fitted on (they are scanned like
    any other).
    """
    rows = docs.select(key.cast("string").alias("k"), text.cast("string").alias("text"))
    rows = rows.where((F.length("text") <= longest) & (F.length("text") > 0))
    marked = F.col("text").rlike("[0-9a-f]{24}|AKIA[A-Z0-9]{16}") | F.col("text").rlike(
        "(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=-]{6}"
    )
    rows = rows.select(F.struct("k", "text").alias("row"), "text", marked.alias("marked"))
    totals = {r.marked: r["count"] for r in rows.groupBy("marked").count().collect()}
    parts = [hash_share(rows.where(F.col("marked") == m), F.col("row"), sample // 2, n) for m, n in totals.items()]
    found = sorted(r.text for part in parts for r in part.select("text").collect())
    return fit(found)


def scan(docs: DataFrame, key: Column, text: Column, sample: int = 2000) -> DataFrame:
    """``doc_id, base, spans`` per row: the patterns' spans and all spans, as ``kind:start:end`` lists."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, key, text, sample))

    def run(texts, rows):
        found = spans(texts, shared.value)
        return {"doc_id": rows.column(1), "base": [joined(b) for b, _ in found], "spans": [joined(s) for _, s in found]}

    schema = "doc_id long, base string, spans string"
    return map_texts(docs, [text, key.cast("long").alias("doc_id")], run, schema, limit=1 << 20)


def digest(found: DataFrame) -> DataFrame:
    """Counts per pattern, a hash of the patterns' spans, and all spans."""

    def number(kind: str) -> Column:
        return F.size(F.filter(F.split("base", ","), lambda s: s.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"), F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans"
    )
