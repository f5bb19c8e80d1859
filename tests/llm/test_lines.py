import pytest
from compare import differences
from pyspark.sql import functions as F
from text_cases import make_docs, odd_rows, prose  # noqa: F401 (fixtures)

from footfall.llm import line_templates as lt
from footfall.llm.queries import ORACLE, QUERIES


def corpus():
    """Boilerplate with a varying field, one that varies in a word, and lines of documents' own."""
    rows = []
    for i in range(30):
        lines = [prose(1000 + i, 30), f"Posted on 2024-01-{i:02d} by user{i} in the archive", prose(2000 + i, 30)]
        if i % 2:
            lines.append(f"See also the page about {chr(97 + i % 20)}{chr(98 + i % 20)}word in our large free encyclopedia of trees")
        rows.append((i, "\n".join(lines)))
    rows += [(100 + i, prose(50, 60) + "\n" + prose(51, 60)) for i in range(20)]  # copies of one document
    return rows


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_recurring_templates_go(make_docs):
    rows = corpus()
    out = texts(lt.drop_recurring(make_docs(rows)))
    for i, text in rows:
        expected = [line for line in text.split("\n") if not line.startswith(("Posted on", "See also"))]
        assert out[i] == "\n".join(expected)


def test_mostly_boilerplate_documents_lose_it_and_count(make_docs):
    """A passage of 60 words in 15 documents, six of which have only 50 words of their own."""
    shared = prose(3000, 60)
    rows = [(i, shared + "\n" + prose(3100 + i, 50 if i < 6 else 90)) for i in range(15)]
    assert texts(lt.drop_recurring(make_docs(rows))) == {i: text.split("\n")[1] for i, text in rows}


def test_copies_with_other_numbers_count_once(make_docs):
    rows = [(i, prose(60, 40) + f"\nseen on day {i} of the month\n" + prose(61, 40)) for i in range(20)]
    assert texts(lt.drop_recurring(make_docs(rows))) == dict(rows)


def test_a_leaf_has_several_templates(make_docs):
    """Two families and unrelated lines share a token count and three leading tokens."""
    name = [prose(4000 + i, 1) + "abcdefghijklmnopqrstuvwxyz"[i % 26] for i in range(150)]
    tails = [f"{n} in our free online travel guide to Europe" for n in name[:60]]
    tails += [f"{n} on the official company support and help pages" for n in name[60:80]]
    unrelated = [prose(4500 + i, 9) for i in range(40)]
    rows = [(i, f"{prose(5000 + i, 30)}\nRead more about {tail}\n{prose(5500 + i, 30)}") for i, tail in enumerate(tails + unrelated)]
    out = texts(lt.drop_recurring(make_docs(rows)))
    for i, text in rows:
        first, middle, last = text.split("\n")
        assert out[i] == (text if i >= 80 else f"{first}\n{last}"), middle


def test_few_documents_are_not_enough(make_docs):
    rows = corpus()[:9]
    assert texts(lt.drop_recurring(make_docs(rows))) == dict(rows)


def test_short_lines_recur_too_and_blank_lines_stay(make_docs):
    rows = [(i, f"Menu\n\n{prose(6000 + i, 30)}\nPage {i}\n \n{prose(6500 + i, 30)}") for i in range(20)]
    out = texts(lt.drop_recurring(make_docs(rows)))
    for i, text in rows:
        lines = text.split("\n")
        assert out[i] == "\n".join([lines[1], lines[2], lines[4], lines[5]])


def test_a_document_of_many_lines_takes_linear_time(make_docs):
    """40 000 lines, half of them in every document."""
    shared = [prose(7000 + i, 5) for i in range(200)]
    own = [prose(8000 + i, 6) for i in range(200)]
    long = "\n".join(f"{shared[i % 200]}\n{own[i % 200]}" for i in range(20_000))
    rows = [(0, long)] + [(1 + i, "\n".join(shared) + "\n" + prose(9000 + i, 30)) for i in range(15)]
    out = texts(lt.drop_recurring(make_docs(rows)))
    assert out[0] == "\n".join(own[i % 200] for i in range(20_000))


def test_columns_with_the_operators_own_names(make_docs):
    names = ["_d", "_d2", "_gone", "_rest", "_lines", "lines", "rest", "__gone", "t", "w"]
    docs = make_docs(corpus()).select("*", *[F.lit(n).alias(n) for n in names if n != "t"])
    out = lt.drop_recurring(docs)
    assert out.columns == docs.columns and out.first()["_gone"] == "_gone"
    assert texts(out) == texts(lt.drop_recurring(make_docs(corpus())))


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    out = lt.drop_recurring(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, (tuple(r) for r in docs.collect())))
    assert lt.drop_recurring(docs.limit(0)).count() == 0


def test_repeated_rows_are_all_rewritten(make_docs):
    rows = corpus() + corpus()[:1]
    found = [r.text for r in lt.drop_recurring(make_docs(rows)).where("doc_id = 0").collect()]
    assert len(found) == 2 and len(set(found)) == 1 and "Posted" not in found[0]


def test_no_python_on_the_path(spark, make_docs, tmp_path, capsys):
    make_docs(corpus()[:12]).write.parquet(str(tmp_path / "docs"))
    lt.mark_recurring(spark.read.parquet(str(tmp_path / "docs"))).explain("formatted")
    plan = capsys.readouterr().out
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def families():
    """Lines of several templates in one leaf, some with a member that recurs by itself."""
    name = [prose(4000 + i, 1) + "abcdefghijklmnopqrstuvwxyz"[i % 26] for i in range(90)]
    tails = [f"{n} in our free online travel guide to Europe" for n in name[:40]]
    tails += [f"{n} on the official company support and help pages" for n in name[40:60]] + [tails_same for tails_same in ["him in our free online travel guide to Europe"] * 12]
    tails += [prose(4500 + i, 9) for i in range(20)]
    return [(200 + i, f"{prose(5000 + i, 12)}\nRead more about {tail}\n{prose(5500 + i, 12)}\nMenu") for i, tail in enumerate(tails)]


def test_sql_agrees_on_templates(spark, make_docs, odd_rows, tmp_path):
    """Among them documents that are mostly boilerplate and several templates a leaf."""
    duckdb = pytest.importorskip("duckdb")
    shared = prose(3000, 60)
    mostly = [(400 + i, shared + "\n" + prose(3100 + i, 50 if i < 6 else 90)) for i in range(15)]
    make_docs(corpus() + families() + mostly + odd_rows[:6]).select("doc_id", "text").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert differences(QUERIES["op10_line_dedup"](spark, str(tmp_path)), duck, ORACLE["op10_line_dedup"]) == []




@pytest.mark.parametrize("text, expected", [("a1 b\tc2c", "<*> b <*>"), ("no digits", "no digits"), ("x-9.\n8", "<*>\n<*>")])
def test_fields_are_masked(spark, text, expected):
    assert spark.createDataFrame([(text,)], "s string").select(lt.masked(F.col("s"))).first()[0] == expected
