"""WARC archives with resolved revisits.

``write_pages`` writes one response record per page. ``resolve`` reads archives, shuffles the
records' headers by payload digest, takes the record with the smallest page id (then the smallest
record id) of each digest as the original, joins the others to it, and writes new archives in which
they are revisit records without payload and all headers are fresh. ``read_records`` reads any such
archive back; a response's digest is computed from its payload and must equal its header.

Archives are gzipped ``WARC/1.1`` files that Spark's text writer stores with the record end as
line end, so they lie wherever Spark can write. A file holds at most ``FILE_BYTES`` of payload (or
one record) and is read whole by one task, records being found by their content length.

Defined cases: a null page is an empty payload; payloads under ``MIN_BYTES`` are never revisits;
a null ``page_id`` is never preferred as an original and comes back null; rows that repeat page id
and payload are told apart by record id, so all but one revisit the first; control characters and
spaces of a url are percent-coded and a null url is ``urn:none``; empty tables give empty archives;
further columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import materialise, scratch_path

MIN_BYTES = 100
FILE_BYTES = 32 << 20
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = (
    "record_id string, page_id long, url string, record_type string, payload_bytes long, "
    "payload_digest string, refers_id string, refers_to long"
)


def http_head(size: Column) -> Column:
    return F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit(END)
    )


def record_head(kind, record_id, page_id, url, digest, size, block_bytes, refers_id=None, refers_to=None) -> Column:
    """Header lines of a record and the empty line after them."""
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), digest),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("X-Page-ID: "), F.coalesce(page_id.cast("string"), F.lit(""))),
    ]
    if refers_id is not None:
        lines += [
            F.when(refers_id.isNotNull(), F.lit(f"WARC-Profile: {PROFILE}")),
            F.concat(F.lit("WARC-Refers-To: "), refers_id),
            F.concat(F.lit("X-Refers-To-Page-ID: "), F.coalesce(refers_to.cast("string"), F.when(refers_id.isNotNull(), ""))),
        ]
    return F.concat(F.concat_ws("\r\n", *lines, F.concat(F.lit("Content-Length: "), block_bytes.cast("string"))), F.lit(END))


def write_pages(pages: DataFrame, page_id: Column, url: Column, html: Column, path: str) -> None:
    """One response record per row."""
    payload = F.coalesce(html.cast("string"), F.lit(""))
    clean = F.coalesce(F.regexp_replace(url.cast("string"), "[\\x00-\\x20\\x7f]", "%20"), F.lit("urn:none"))
    rows = pages.select(
        page_id.cast("long").alias("page_id"), clean.alias("url"), payload.alias("html"),
        F.concat(F.lit("<urn:page:"), F.monotonically_increasing_id().cast("string"), F.lit(">")).alias("record_id"),
    )
    size, head = F.octet_length("html"), http_head(F.octet_length("html"))
    value = F.concat(
        record_head(
            F.lit("response"), F.col("record_id"), F.col("page_id"), F.col("url"),
            F.sha2(F.col("html").cast("binary"), 256), size, F.octet_length(head) + size,
        ),
        head, "html",
    )
    largest = pages.agg(F.max(F.octet_length(payload))).first()[0] or 0
    _write(rows.select(value.alias("value")), path, largest)


def _write(records: DataFrame, path: str, largest: int) -> None:
    per_file = max(1, FILE_BYTES // (largest + 1024))
    records.write.options(lineSep=END, maxRecordsPerFile=per_file, compression="gzip").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def parse(content: bytes):
    """``(headers, http block start, block end)`` of each record of an unpacked archive."""
    at = 0
    while at < len(content):
        stop = content.index(b"\r\n\r\n", at)
        lines = content[at:stop].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        begin = stop + 4
        end = begin + int(headers["Content-Length"])
        yield headers, begin, end
        at = end + 4


def _record(headers: dict[str, str], block: bytes) -> tuple:
    stop = block.index(b"\r\n\r\n") + 4
    http = dict(line.split(": ", 1) for line in block[:stop].decode().strip().split("\r\n")[1:])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if headers["WARC-Type"] == "response" and hashlib.sha256(memoryview(block)[stop:]).hexdigest() != digest:
        raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
    number = lambda name: int(headers[name]) if headers.get(name) else None
    return (
        headers["WARC-Record-ID"], number("X-Page-ID"), headers["WARC-Target-URI"], headers["WARC-Type"],
        int(http["Content-Length"]), digest, headers.get("WARC-Refers-To"), number("X-Refers-To-Page-ID"),
    )


KINDS = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Header values of all records, with the ``file`` they are in."""
    names = [c.split()[0] for c in RECORD.split(", ")]

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                content = gzip.decompress(content)
                rows = [_record(h, content[a:b]) for h, a, b in parse(content)]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), KINDS)] if rows else [pa.array([], k) for k in KINDS]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([file] * len(rows), pa.string())], names=[*names, "file"])

    return _files(spark, path).select("path", "content").mapInArrow(run, f"{RECORD}, file string")


def decide(records: DataFrame) -> DataFrame:
    """``file, record_id, refers_id, refers_to`` for the records that become revisits."""
    order = F.struct(F.col("page_id").isNull(), "page_id", "record_id")
    large = records.where(F.col("payload_bytes") >= MIN_BYTES)
    first = large.groupBy("payload_digest").agg(F.min(order).alias("o"), F.count("*").alias("n")).where("n > 1")
    first = first.select("payload_digest", F.col("o.record_id").alias("refers_id"), F.col("o.page_id").alias("refers_to"))
    own = large.select("file", "record_id", "payload_digest")
    return own.join(first, "payload_digest").where("record_id <> refers_id").drop("payload_digest")


def resolve(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite the archives at ``source`` to ``target`` with duplicates as revisit records."""
    records = materialise(read_records(spark, source), "warc-headers")
    largest = records.agg(F.max("payload_bytes")).first()[0] or 0
    fates = decide(records).groupBy("file").agg(F.collect_list(F.struct("record_id", "refers_id", "refers_to")).alias("fates"))

    def run(batches):
        for batch in batches:
            for content, fates in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                content = gzip.decompress(content)
                fate = {f["record_id"]: f for f in fates or ()}
                rows = []
                for headers, begin, end in parse(content):
                    record_id, page, url, kind, size, digest, refers_id, refers_to = _record(headers, content[begin:end])
                    if record_id in fate:
                        kind, refers_id, refers_to = "revisit", fate[record_id]["refers_id"], fate[record_id]["refers_to"]
                    payload = content[content.index(b"\r\n\r\n", begin) + 4 : end].decode() if kind == "response" else ""
                    rows.append((record_id, page, url, kind, size, digest, refers_id, refers_to, payload))
                for low in range(0, len(rows), 256):
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows[low : low + 256]), [*KINDS, pa.string()])]
                    names = [c.split()[0] for c in RECORD.split(", ")]
                    yield pa.RecordBatch.from_arrays(columns, names=[*names, "payload"])

    files = _files(spark, source).select("content", F.col("path").alias("file"))
    joined = files.join(fates, "file", "left").select("content", "fates")
    rows = joined.mapInArrow(run, f"{RECORD}, payload string")
    head = http_head(F.col("payload_bytes"))
    value = F.concat(
        record_head(
            F.col("record_type"), F.col("record_id"), F.col("page_id"), F.col("url"), F.col("payload_digest"),
            F.col("payload_bytes"), F.octet_length(head) + F.octet_length("payload"), F.col("refers_id"), F.col("refers_to"),
        ),
        head, "payload",
    )
    _write(rows.select(value.alias("value")), target, largest)


def archive_pages(pages: DataFrame, page_id: Column, url: Column, html: Column) -> DataFrame:
    """Write ``pages``, resolve revisits, and return the new archives' records."""
    spark = pages.sparkSession
    raw, resolved = scratch_path(spark, "warc"), scratch_path(spark, "warc-resolved")
    write_pages(pages, page_id, url, html, raw)
    resolve(spark, raw, resolved)
    return read_records(spark, resolved).drop("file")
