"""Texts for the tests of the text operators."""

import random

import pytest
from pyspark.sql import functions as F

SYLLABLES = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in ("", "n", "r", "s")]
#: Further columns, named like the operators' own.
CLASHING = ["score", "fp", "h", "d", "t", "kept", "component_id", "ids", "piece", "word", "g", "n", "held_out"]


def prose(seed: int, n: int = 80) -> str:
    """``n`` invented words, about as compressible as a real text."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.choice((1, 2, 2, 3)))) for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from ``(doc_id, text)`` pairs, with clashing further columns."""

    def build(rows):
        table = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, n_chars long")
        return table.select("*", *[F.lit("x").alias(c) for c in CLASHING]).repartition(3)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, a null key, a repeated row, a very long text and unusual characters."""
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, prose(5)), (6, prose(6)), (6, prose(6)),
        (7, " ".join(prose(i, 200) for i in range(60))), (8, "é 你好 \U0001F600\x00 a b ﬁ ▁x"), (9, prose(6)),
    ]
