import base64
import os
import random
from collections import Counter

import zstandard
from text_cases import make_docs, odd_rows, prose  # noqa: F401 (fixtures)
from pyspark.sql import functions as F

from footfall.llm import quality_bands as q


def brute(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in "\x20\x09\x0a\x0b\x0c\x0d":
            words += [word] if word else []
            word = ""
        else:
            word += c
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip("\x20\x09\x0a\x0b\x0c\x0d"):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": dup, "n_repeat_words": len(covered), "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


def test_base_fields_equal_a_plain_count(make_docs, odd_rows):
    rows = odd_rows + [(20, "a b c a b c a b"), (21, "x # y\n\nx # y\n \nx # y"), (22, prose(1) + "\n" + prose(1))]
    for r in q.measure(make_docs(rows), F.col("doc_id"), F.col("text")).collect():
        texts = {t for i, t in rows if i == r.doc_id}
        assert len(texts) == 1
        expected = brute(texts.pop())
        assert {k: r[k] for k in expected} == expected


def test_verdict_follows_the_bands():
    compress = zstandard.ZstdCompressor(level=q.LEVEL).compress
    noise = " ".join(base64.b64encode(os.urandom(30)).decode() for _ in range(200))
    varied = "\n".join(f"{i} " + "ab" * 30 for i in range(100))
    for text, kept in ((prose(2, 400), True), (noise, False), (varied, False), ("", False)):
        judged = q.judge(text, compress)
        assert judged[6] is kept, judged
    mixed = prose(3, 900) + " " + noise  # the whole passes or not, but too many chunks are out
    assert q.judge(mixed, compress)[9] > 0 and not q.judge(mixed, compress)[6]


def test_filter_keeps_rows_and_columns(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["6", "6", "7", "9", "None"]
    assert q.keep_good(docs.limit(0)).count() == 0
    assert q.measure(docs.limit(0), F.col("doc_id"), F.col("text")).count() == 0


def noise(seed, size):
    return base64.b64encode(random.Random(seed).randbytes(size)).decode()[:size]


def test_fitted_bands_bind(make_docs):
    clean = [(i, prose(i, 110 + 37 * i % 900)) for i in range(1800)] + [(5000 + i, prose(i, 1300)) for i in range(250)]
    copies = [(9000 + i, " ".join(f"{j}" * 40 for j in range(60))) for i in range(1500)]  # one text, unlike the rest
    docs = make_docs(clean + copies)
    bands = q.fit_bands(docs, F.col("text"))
    compress = zstandard.ZstdCompressor(level=q.LEVEL).compress

    def kept(texts):
        return sum(q.judge(t, compress, bands=bands)[6] for t in texts)

    assert kept(t for _, t in clean) >= 0.99 * len(clean)
    paragraph = prose(77, 45)
    planted = {
        "noise tail": [prose(i, 600) + " " + noise(i, 3900) for i in range(40)],
        "noise words": [" ".join(w if j % 10 > 2 else noise(i * j, 9) for j, w in enumerate(prose(i, 700).split())) for i in range(40)],
        "long copies": [text for _, text in copies[:40]],
        "varied paragraphs": [" ".join(f"{paragraph} {j}" for j in range(20)) for _ in range(40)],
    }
    assert {name: kept(texts) for name, texts in planted.items()} == dict.fromkeys(planted, 0)
    found = q.measure(docs, F.col("doc_id"), F.col("text")).where("kept").count()
    assert found == kept(t for _, t in clean) == q.keep_good(docs).count()


def test_the_tail_is_a_chunk():
    compress = zstandard.ZstdCompressor(level=q.LEVEL).compress
    for size, chunks in ((4095, 0), (4096, 1), (4097, 2), (8192, 2), (8193, 3)):
        assert q.judge((prose(4, 2000))[:size], compress)[8] == chunks


def test_few_texts_take_the_general_bands(make_docs, odd_rows):
    assert q.fit_bands(make_docs(odd_rows), F.col("text"))[10] == (512, *q.band(512))
    assert q.fit_bands(make_docs(odd_rows).limit(0), F.col("text"))[0] == (0, *q.band(0))
