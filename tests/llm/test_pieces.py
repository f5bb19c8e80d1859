import random
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from text_cases import make_docs, odd_rows, prose  # noqa: F401 (fixtures)

from footfall.llm import pieces_viterbi as pv

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pv.Pieces(PATH)


def brute(vocabulary, text):
    """Best pieces of the whole text at once, without cutting it into segments."""
    return pv.best_by_dictionary(vocabulary, pv.MARK + text.replace(" ", pv.MARK)) if text else []


def samples(odd_rows):
    rng = random.Random(3)
    mixed = "".join(rng.choice("abcdeéß 你😀\n\t.,;▁ \x00ﬁ") for _ in range(400))
    return [t or "" for _, t in odd_rows if len(t or "") < 5000] + [mixed, "   a  b ", "\n\n", "internationalization of Tokenizers, 2024!"]


def test_ids_are_the_best_pieces(vocabulary, odd_rows):
    texts = samples(odd_rows)
    assert [i.tolist() for i in pv.encode(vocabulary, texts)] == [brute(vocabulary, t) for t in texts]


def test_long_segments_and_memory(vocabulary):
    long = "ab" * 3000
    known = pv.Known(most=5)
    for text in (long, prose(1), prose(2), long):
        assert pv.encode(vocabulary, [text], known, limit=4096)[0].tolist() == brute(vocabulary, text)


def test_the_library_decodes_the_ids(vocabulary, odd_rows):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in samples(odd_rows):
        ids = pv.encode(vocabulary, [text])[0]
        assert pv.decode(vocabulary, ids) == model.decode(ids.tolist())
        assert pv.decode(vocabulary, ids) == text.replace(pv.MARK, " ")


def test_a_collision_is_noticed(vocabulary, monkeypatch):
    monkeypatch.setattr(pv, "hashes", lambda points: np.zeros((points.shape[0], points.shape[1] + 1), dtype=np.uint64))
    broken = pv.Pieces(PATH)
    assert pv.encode(broken, ["the tree is tall"])[0].tolist() == brute(vocabulary, "the tree is tall")


def test_tables(make_docs, odd_rows, vocabulary):
    docs = make_docs(odd_rows)
    found = pv.encode_documents(docs, F.col("doc_id"), F.col("text"), PATH).collect()
    expected = sorted((str(i), brute(vocabulary, t or "")) for i, t in odd_rows if len(t or "") < 5000)
    assert sorted((str(r.doc_id), r.ids) for r in found if r.doc_id != 7) == expected
    assert all(r.decodes for r in pv.digest_documents(docs, F.col("doc_id"), F.col("text"), PATH).collect())
    assert pv.digest_documents(docs.limit(0), F.col("doc_id"), F.col("text"), PATH).count() == 0


def test_a_long_text_without_blanks_takes_linear_time(vocabulary):
    def seconds(n):
        text = "".join(random.Random(n).choices("abcdefghij", k=n))
        began = time.perf_counter()
        ids = pv.encode(vocabulary, [text])[0]
        assert pv.decode(vocabulary, ids) == text
        return time.perf_counter() - began

    seconds(10_000)
    assert seconds(200_000) < 8 * seconds(50_000)
