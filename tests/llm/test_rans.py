import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from text_cases import make_docs, odd_rows, prose  # noqa: F401 (fixtures)
from tokenizers import Tokenizer

from footfall.llm import rans

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    sizes = [1, 5, 31, 32, 33, 100, rans.LANES * rans.EVERY, rans.LANES * rans.EVERY + 1, 40_000]
    blocks = [np.minimum(rng.zipf(1.3, n), 4000).astype(np.int32) for n in sizes]
    table = rans.Table(rans.quantise(np.bincount(np.concatenate(blocks))))
    payloads = rans.encode_blocks(table, blocks)
    for order in (range(len(blocks)), reversed(range(len(blocks)))):
        order = list(order)
        for want, got in zip(order, rans.decode_blocks(table, [payloads[i] for i in order])):
            assert np.array_equal(blocks[want], got)
    counts = np.bincount(blocks[-1])
    entropy = -(counts[counts > 0] * np.log2(counts[counts > 0] / counts.sum())).sum() / 8
    assert len(payloads[-1]) < 1.1 * entropy + 1500
    assert rans.decode_blocks(table, []) == [] and rans.encode_blocks(table, []) == []


def test_a_stretch_decodes_from_its_checkpoint():
    ids = (np.arange(rans.LANES * rans.EVERY * 3) % 17).astype(np.int32)
    table = rans.Table(rans.quantise(np.bincount(ids)))
    (payload,) = rans.encode_blocks(table, [ids])
    n, count = np.frombuffer(payload, "<u4", 2).tolist()
    size = rans.HEAD.itemsize
    last = np.frombuffer(payload, rans.HEAD, count, 8)[-1]
    stream = payload[8 + count * size + 4 * int(last["place"]) :]
    head = np.uint32(0).tobytes() + last["state"].astype("<u8").tobytes()
    alone = np.array([rans.LANES * rans.EVERY, 1], "<u4").tobytes() + head + stream
    assert np.array_equal(rans.decode_blocks(table, [alone])[0], ids[-rans.LANES * rans.EVERY :])


def test_frequencies():
    for counts in ([0, 5, 0, 1], [1], [10**9, 1, 0, 1], list(range(3000))):
        freq = rans.quantise(np.array(counts))
        assert freq.sum() == 1 << rans.SCALE and all((f > 0) == (c > 0) for f, c in zip(freq, counts))
    assert rans.quantise(np.zeros(3, dtype=np.int64)).tolist() == [0, 0, 0]
    with pytest.raises(ValueError):
        rans.encode_blocks(rans.Table(rans.quantise(np.array([1, 0]))), [np.array([1], dtype=np.int32)])


def test_parts_are_encoded_as_whole_texts():
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["", "Hello  World\tit's 42!", "É é ÅNGSTRÖM ΣΑΣ ﬁ İ", "a<|endoftext|>b <|STARTOFTEXT|> <|startoftext|>", "x y z \x1f \x85 #", "你好😀 " * 3, prose(3)]
    rng = random.Random(1)
    marks = [chr(c) for c in (*range(33, 127), *range(0xA0, 0x250), 39, 39, 39, 0x301, 0x1C, 0x85, 0x2028)]
    texts += ["".join(rng.choice(marks) if rng.random() < 0.85 else " " for _ in range(100)) for _ in range(100)]
    texts += ["it's 'sun ''t don't'll ÀÉÎ ß'd 'RE 'Ve'M #1! 3.14 a_b-c"]
    encoder = rans.Encoder(Path(PATH).read_text(encoding="utf-8"), most=3)
    for _ in range(2):
        for text, own in zip(texts, encoder.encode(pa.array(texts), 2)):
            assert own.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_other_definitions_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, encoder = Tokenizer.from_file(path), rans.Encoder(Path(path).read_text(encoding="utf-8"))
    texts = ["two  words\n", "", " lead", None]
    assert not encoder.by_part and rans.Encoder(Path(PATH).read_text(encoding="utf-8")).by_part
    for text, own in zip(texts, encoder.encode(pa.array(texts), 7)):
        assert own.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 7]


def test_many_rows_of_one_id_are_spread(spark, tmp_path):
    """Of rows without an id, which are most, some are equal; no range holds them all."""
    rows = [(None, prose(i % 50, 30)) for i in range(400)] + [(i, prose(i, 30)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = rans.digest(rans.store_documents(docs, F.col("doc_id"), F.col("text"), PATH, str(tmp_path / "s")))
    starts = sorted((r.start, r.n_tokens) for r in out.collect())
    assert len(starts) == 420 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    own = spark.read.parquet(str(tmp_path / "s/blocks")).where("doc_ids[0] is null").select("part").distinct().count()
    assert own > 1


def test_store(spark, make_docs, odd_rows, tmp_path):
    rows = odd_rows + [(100 + i, prose(i, 400)) for i in range(60)]
    docs = make_docs(rows)
    stored = rans.store_documents(docs, F.col("doc_id"), F.col("text"), PATH, str(tmp_path / "s"))
    out = rans.digest(stored).orderBy("start").collect()
    assert [r.doc_id for r in out] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    tokenizer = Tokenizer.from_file(PATH)
    crc = {}
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        crc.setdefault(i, (len(ids), zlib.crc32(ids.tobytes())))
    at = 0
    for r in out:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, *crc[r.doc_id])
        at += r.n_tokens
    blocks = spark.read.parquet(str(tmp_path / "s/blocks"))
    broken = blocks.withColumn("crc32", F.col("crc32") + 1)
    broken.write.parquet(str(tmp_path / "broken/blocks"))
    spark.read.parquet(str(tmp_path / "s/table")).write.parquet(str(tmp_path / "broken/table"))
    with pytest.raises(Exception, match="damaged"):
        rans.read_store(spark, str(tmp_path / "broken")).count()


def test_empty_store(make_docs, tmp_path):
    empty = make_docs([(1, "a")]).limit(0)
    assert rans.store_documents(empty, F.col("doc_id"), F.col("text"), PATH, str(tmp_path / "e")).count() == 0
