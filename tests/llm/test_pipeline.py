import random

import corpus_pipeline as pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from text_cases import prose

from footfall.llm import decontaminate, line_templates, pieces_viterbi, quality_bands, simhash


@pytest.fixture
def folder(spark, tmp_path):
    """Documents with junk, copies, shared lines and benchmark passages, and odd rows."""
    rng = random.Random(1)
    items = [(i, prose(8000 + i, 25)) for i in range(5)]
    rows = [(i, prose(i, 100 + i) + ("\nRead 12 more pages like this in the big archive" if i < 15 else "")) for i in range(40)]
    rows += [(100 + i, rows[20][1]) for i in range(12)] + [(200 + i, "buy now " * 200) for i in range(3)]
    rows += [(300 + i, prose(700 + i) + " " + rng.choice(items)[1] + " " + prose(800 + i)) for i in range(4)]
    rows += [(400, None), (401, ""), (402, "too short"), (None, prose(5555, 90)), (5, rows[5][1])]
    table = spark.createDataFrame([(i, t, "en", "s", None, "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, fp string")
    table.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), rows, items


def test_stages_have_the_given_order():
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "benchmark_decontamination", "sentencepiece"]


def test_rows_equal_a_plain_run(spark, folder):
    path, rows, items = folder
    import zstandard

    compress = zstandard.ZstdCompressor(level=quality_bands.LEVEL).compress
    docs = [(i, t) for i, t in rows if quality_bands.judge(t or "", compress)[6]]
    docs = [(i, "\n".join(line for line in t.split("\n") if not line.startswith("Read 12"))) for i, t in docs]
    prints = dict(zip([t for _, t in docs], simhash.fingerprints_of([t for _, t in docs]).tolist()))
    root = {p: p for p in prints.values()}
    for a in root:
        for b in root:
            if bin(a ^ b).count("1") <= 2:
                x = min(root[a], root[b])
                root = {p: x if r in (root[a], root[b]) else r for p, r in root.items()}
    best = {}
    for i, t in docs:
        if i is not None and (root[prints[t]] not in best or best[root[prints[t]]][0] > i):
            best[root[prints[t]]] = (i, t)
    docs = [*best.values(), *[(i, t) for i, t in docs if i is None]]
    held = [decontaminate.normal(t) for _, t in items]
    docs = [(i, t) for i, t in docs if not any(h in decontaminate.normal(t) for h in held)]
    vocabulary = pieces_viterbi.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    expected = sorted((str(i), pieces_viterbi.best_by_dictionary(vocabulary, "▁" + t.replace(" ", "▁"))) for i, t in docs)
    found = pipeline.run(spark, path).collect()
    assert sorted((str(r.doc_id), r.ids) for r in found) == expected
    assert all(r.n_tokens == len(r.ids) for r in found)
    assert {r.doc_id for r in found} == {*range(40), None}


def test_columns_stay(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns, name
    line = dict(pipeline.STAGES)["line_dedup"](spark, docs, path)
    assert line.where("text is not null and n_chars <> length(text)").count() == 0


def test_empty_table(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0


def test_line_stage_is_native(spark, folder, capsys):
    path, _, _ = folder
    line_templates.drop_recurring(spark.read.parquet(f"{path}/documents.parquet")).select(F.col("text")).explain()
    assert "Python" not in capsys.readouterr().out
