import re

import duckdb
import pytest
from pyspark.sql import functions as F
from text_cases import make_docs, odd_rows  # noqa: F401

from footfall.llm import license_index as li
from footfall.llm.license_index import Template

COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def plain(text):
    """Base columns by trying every place."""
    words = words_of(text)
    found = [(i, p) for p in BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    places = [i for i, _ in found]
    labels = ",".join(sorted({BASE[p] for _, p in found}))
    return len(words), len(found), min(places, default=None), max(places, default=None), labels


MIT = next(t.text for t in li.NOTICES if t.label == "mit-text")
ROWS = [
    (20, "Released under the MIT License. (c) 2020"), (21, "APACHE\tlicense,apache LICENSE; cc-by cc_by CC BY cc  by"),
    (22, "gnu general public gnu general public license"), (23, "mit mit license license mit license"),
    (24, "Licensed under the Apache License, Version 2.0 (the License)"), (25, f"x y z {MIT.upper()}. The end."),
    (26, "Licensed under CC BY-NC 4.0."), (27, "cc by"), (28, "by cc"), (29, "apachelicense apache-licence Kache license"),
    (30, MIT.replace("without restriction", "with restriction")), (31, "the " * 3000 + "mit license " * 400),
    (32, "cc\x00by cc by é mit\x7flicense"), (33, " ".join(MIT.split()[:20] + ["extra", "words"] + MIT.split()[20:])),
    (34, "This work is licensed under the GNU General Public License, version 3."),
]


@pytest.fixture
def scanned(make_docs, odd_rows):
    rows = odd_rows + ROWS
    return rows, li.scan(make_docs(rows), F.col("doc_id"), F.col("text"))


def test_base_equals_plain(scanned):
    rows, found = scanned
    found = sorted((tuple(r[c] for c in COLUMNS[:6]) for r in li.digest(found).collect()), key=str)
    assert found == sorted(((i, *plain(t)) for i, t in rows), key=str)


def test_labels(scanned):
    labels = {r.doc_id: r.labels for r in li.digest(scanned[1]).collect()}
    assert labels[20] == "mit,mit-notice" and labels[24] == "apache,apache-2.0" and labels[25] == "mit-text"
    assert labels[26] == "cc-by,cc-by-nc-4.0" and labels[34] == "gpl,gpl-3.0" and labels[33] == "mit-text"
    assert labels[28] == "" and labels[30] == "" and labels[31] == "mit"  # a missing key phrase is no license


def test_score_is_the_found_share(scanned):
    score = {r.doc_id: r.score for r in li.digest(scanned[1]).collect()}
    assert score[25] == 1 and score[2] == 0 and score[27] == 1 and all(0 <= s <= 1 for s in score.values())


def test_equals_sql(spark, make_docs, odd_rows, tmp_path):
    docs = make_docs(odd_rows + ROWS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    cursor = base.execute(li.oracle())
    names = [d[0] for d in cursor.description]
    expected = [dict(zip(names, r)) for r in cursor.fetchall()]
    found = li.digest(li.scan(docs, F.col("doc_id"), F.col("text"))).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in found), key=str) == sorted((tuple(r[c] for c in COLUMNS) for r in expected), key=str)


def test_rare_words_come_from_the_corpus(make_docs):
    template = [Template("x", "alpha beta", ("alpha beta",), True)]
    common_alpha = make_docs([(i, "alpha") for i in range(5)] + [(9, "alpha beta")])
    rows = common_alpha.select(li.words_of(F.col("text")).alias("words"))
    counts = li.document_counts(rows, template)
    assert counts == {"alpha": 6, "beta": 1} and li.postings(template, counts) == {"beta": [(0, 1)]}


def test_plan_is_native_and_moves_no_text(make_docs, capsys):
    li.digest(li.scan(make_docs(ROWS), F.col("doc_id"), F.col("text"))).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") <= 1  # the fixture's own


def test_empty_table_and_no_template(make_docs):
    docs = make_docs(ROWS)
    assert li.digest(li.scan(docs.limit(0), F.col("doc_id"), F.col("text"))).count() == 0
    assert {r.labels for r in li.digest(li.scan(docs, F.col("doc_id"), F.col("text"), [])).collect()} == {""}
