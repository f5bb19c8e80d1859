import gzip
import hashlib

import pytest
from pyspark.sql import functions as F
from text_cases import prose

from footfall.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    big = "<html>" + prose(1, 60) + "</html>"
    tricky = "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 9
    rows = [
        (5, "http://a/1", big), (2, "http://a/2", big), (9, None, big), (3, "http://a/ b\r\nX: y", "short"), (4, "u", "short"),
        (6, "u", None), (7, "u", ""), (8, "http://a/é", "é你😀" * 40), (10, "u", "é你😀" * 40), (None, "u", big), (11, "u", tricky),
        (12, "u", tricky), (2, "http://a/2", big), (13, "u", "x\r\n\r\n\n\n"), (14, "u", "<p>" + "y" * 200_000), (15, "u", "z" * 99), (16, "u", "z" * 99),
    ]
    table = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    return table.repartition(4), rows


def archive(table):
    return warc.archive_pages(table, F.col("page_id"), F.col("url"), F.col("html"))


def test_records(pages):
    table, rows = pages
    out = archive(table).collect()
    assert len(out) == len(rows)
    smallest = {}
    for i, _, html in rows:
        if i is not None:
            smallest[html or ""] = min(i, smallest.get(html or "", i))
    expected = []
    for i, _, html in set(rows):
        raw = (html or "").encode()
        first = smallest[html or ""]
        kind = "revisit" if len(raw) >= 100 and i != first else "response"
        expected += [(str(i), len(raw), hashlib.sha256(raw).hexdigest(), kind, first if kind == "revisit" else None)]
    found = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out]
    assert sorted(set(map(str, expected))) == sorted(set(map(str, found)) - {str(("2", *next(f for f in found if f[0] == "2" and f[3] == "revisit")[1:]))})
    twice = [r for r in out if r.page_id == 2]
    assert sorted(r.record_type for r in twice) == ["response", "revisit"]
    ids = {r.record_id: r for r in out}
    for r in out:
        if r.record_type == "revisit":
            assert ids[r.refers_id].record_type == "response" and ids[r.refers_id].payload_digest == r.payload_digest


def test_payloads_come_back(spark, pages, tmp_path):
    table, rows = pages
    warc.write_pages(table, F.col("page_id"), F.col("url"), F.col("html"), str(tmp_path / "w"))
    payloads = []
    for file in sorted((tmp_path / "w").glob("part-*")):
        content = gzip.decompress(file.read_bytes())
        for headers, begin, end in warc.parse(content):
            payloads.append((headers["X-Page-ID"], content[content.index(b"\r\n\r\n", begin) + 4 : end].decode()))
    assert sorted(payloads) == sorted(("" if i is None else str(i), html or "") for i, _, html in rows)


def test_damage_is_noticed(spark, pages, tmp_path):
    table, _ = pages
    path = tmp_path / "w"
    warc.write_pages(table.where("page_id = 14").coalesce(1), F.col("page_id"), F.col("url"), F.col("html"), str(path))
    file = next(path.glob("part-*"))
    content = gzip.decompress(file.read_bytes())
    with pytest.raises(ValueError, match="damaged"):
        for headers, begin, end in warc.parse(content.replace(b"yyy", b"yxy", 1)):
            warc._record(headers, content.replace(b"yyy", b"yxy", 1)[begin:end])


def test_empty_table(pages):
    assert archive(pages[0].limit(0)).count() == 0
