import hashlib
import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F
from text_cases import make_docs, odd_rows, prose  # noqa: F401 (fixtures)

from footfall.llm import secrets_crf as s


def brute_spans(text):
    """The contract's patterns, each run over the whole text and then sifted."""
    found = []
    name = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer(rf"""({name})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(found)


def secret(rng, alphabet="0123456789abcdef", n=40):
    return "".join(rng.choice(alphabet) for _ in range(n))


def corpus(n=60):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        text = prose(i, 60)
        if i % 2:
            words = text.split()
            words.insert(30, f'{rng.choice(["token", "API_key", "Password"])} = "{secret(rng)}"')
            text = " ".join(words)
        rows.append((i, text))
    return rows


def test_patterns():
    rng = random.Random(1)
    cases = [
        'PassWord: abc', 'password: abcdef', "api_key'='AKIA" + "Z9" * 9, "tokentoken=secret=abcdefgh", "ſecret=abcdefgh",
        "é" * 5 + " " + secret(rng, n=24), secret(rng, n=23), "AKIA" + "A" * 15, "AKIAAKIA" + "B" * 30, "toKen==x token : 'a/b+c=d.e_f-g'", "",
    ]
    for text in cases + [t for _, t in corpus()]:
        assert s.pattern_spans(text) == brute_spans(text), text


def test_viterbi_finds_the_best_labels():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n = int(rng.integers(1, 8))
        score, moves, breaks = rng.normal(size=(n, 3)) * 3, rng.normal(size=(3, 3)), rng.random(n) < 0.2
        score[:, 0] += 2
        breaks[0] = True

        def value(y):
            return sum(score[i, y[i]] for i in range(n)) + sum(moves[y[i - 1], y[i]] for i in range(1, n) if not breaks[i])

        best = max(value(y) for y in itertools.product(range(3), repeat=n))
        assert abs(value(s.viterbi(score, moves, breaks)) - best) < 1e-9


def test_marginals_equal_sums_over_labellings():
    rng = np.random.default_rng(2)
    score, moves = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3))
    node, edge = s.marginals(score, moves)
    expected, pairs = np.zeros_like(node), np.zeros((3, 3))
    for c in range(2):
        weights = {
            y: np.exp(sum(score[c, i, y[i]] for i in range(4)) + sum(moves[a, b] for a, b in zip(y, y[1:])))
            for y in itertools.product(range(3), repeat=4)
        }
        z = sum(weights.values())
        for y, w in weights.items():
            for i, label in enumerate(y):
                expected[c, i, label] += w / z
            for a, b in zip(y, y[1:]):
                pairs[a, b] += w / z
    assert np.allclose(node, expected) and np.allclose(edge, pairs)


def test_the_model_adds_secrets_without_a_name_and_spares_prose():
    rng = random.Random(11)
    model = s.fit([t for _, t in corpus(400)])
    mixed = [f"{prose(900 + i, 20)} {secret(rng, '0123456789ABCDEF')} {prose(950 + i, 20)}" for i in range(30)]
    caught = sum(any(k == 3 for _, k, _ in every) for _, every in s.spans(mixed, model))
    assert caught >= 24
    clean = [prose(5000 + i, 100) for i in range(100)]
    assert not any(every for _, every in s.spans(clean, model))
    for text, (base, every) in zip(mixed, s.spans(mixed, model)):
        assert set(base) <= set(every) and every == sorted(every)
        assert all(0 <= a < b <= len(text) for a, _, b in every)


def test_spans_are_in_code_points():
    model = s.fit([t for _, t in corpus(200)])
    rng = random.Random(3)
    key = secret(rng, "0123456789ABCDEF")
    text = f"é你😀 token = {key} ß"
    base, every = s.spans(["x", text], model)[1]
    assert text[base[0][0] : base[0][2]] == f"token = {key}"
    for a, b in s.tagged([text], model)[0]:
        assert key in text[a:b]


def test_tables(make_docs, odd_rows):
    rows = corpus() + [(i and 1000 + i, t) for i, t in odd_rows]
    docs = make_docs(rows)
    out = s.digest(s.scan(docs, F.col("doc_id"), F.col("text"))).collect()
    assert len(out) == len(rows)
    expected = {i: brute_spans(t or "") for i, t in rows}
    for r in out:
        base = expected[r.doc_id]
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for _, k, _ in base) for x in range(3)]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
    clean = make_docs(odd_rows)  # nothing to learn from
    assert [r.spans for r in s.scan(clean, F.col("doc_id"), F.col("text")).collect()] == [""] * len(odd_rows)
    assert s.scan(docs.limit(0), F.col("doc_id"), F.col("text")).count() == 0
