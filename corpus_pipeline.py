"""Prepare ``documents`` for training in five stages, each one of the text operators.

A stage takes ``(spark, docs, sf_dir)`` and returns what it keeps; its result is written as Parquet
and read again as the next stage's documents. All but the last return the columns of ``documents``.

Rows with a null ``doc_id`` pass near-dedup (they can't name a representative) and all other
stages judge them by their text; null texts fail the quality rules; empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import decontaminate, line_templates, pieces_viterbi, quality_bands, simhash
from footfall.llm.common import load
from footfall.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the word and compression rules keep."""
    return quality_bands.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines whose template recurs; ``n_chars`` is that of the new text."""
    return line_templates.drop_recurring(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs, length=3, distance=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every document."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = pieces_viterbi.encode_documents(docs, F.col("doc_id"), F.col("text"), model)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

ORACLE_SQL = None  # compression, fingerprints and encoding have no SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
