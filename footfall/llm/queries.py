"""One named query per text operator, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    byte_cnn,
    decontaminate,
    gru_lm,
    license_index,
    line_templates,
    periodic_runs,
    pieces_viterbi,
    quality_bands,
    rans,
    secrets_crf,
    simhash,
    turn_trie,
    warc,
)
from footfall.llm.common import crc_fold, load
from footfall.session import scratch_path


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return gru_lm.score(load(spark, folder, "documents"), F.col("doc_id"), F.col("text"), crc_fold(F.col("doc_id")) == 1)


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets_crf.digest(secrets_crf.scan(load(spark, folder, "documents"), F.col("doc_id"), F.col("text")))


def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces_viterbi.digest_documents(load(spark, folder, "documents"), F.col("doc_id"), F.col("text"), model)


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_bands.measure(load(spark, folder, "documents"), F.col("doc_id"), F.col("text"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.simhash_components(load(spark, folder, "documents"), F.col("doc_id"), F.col("text"), length=3, distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = load(spark, folder, "documents"), load(spark, folder, "labels")
    learned = labels.where(crc_fold(F.col("doc_id")) != 0)
    model = byte_cnn.train(docs, F.col("doc_id"), F.col("text"), learned, F.col("doc_id"), F.col("quality"))
    return byte_cnn.score(docs, F.col("doc_id"), F.col("text"), model).select(
        "doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op7_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    pages = load(spark, folder, "pages")
    records = warc.archive_pages(pages, F.col("page_id"), F.col("url"), F.col("html"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document and benchmark item that it holds."""
    docs, benchmark = load(spark, folder, "documents"), load(spark, folder, "benchmark")
    return decontaminate.find_items(docs, F.col("doc_id"), F.col("text"), benchmark, F.col("item_id"), F.col("text"))


def op9_rans_output(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    docs = load(spark, folder, "documents")
    return rans.digest(rans.store_documents(docs, F.col("doc_id"), F.col("text"), tokenizer, scratch_path(spark, "ids")))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    marked = line_templates.mark_recurring(load(spark, folder, "documents"))
    gone = F.coalesce("lines", F.array().cast("array<int>"))
    return marked.select(
        "doc_id",
        F.coalesce(F.size(F.split(F.col("text"), "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_dropped"),
        F.array_join(gone.cast("array<string>"), ",").alias("dropped"),
        F.sha2(F.col("rest").cast("binary"), 256).alias("text_sha256"),
    )


def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_index.digest(license_index.scan(load(spark, folder, "documents"), F.col("doc_id"), F.col("text")))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.digest(load(spark, folder, "documents"), F.col("doc_id"), F.col("text"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    columns = [F.col(c) for c in ("conv_id", "turn", "role", "text")]
    return turn_trie.prefix_trie(load(spark, folder, "conversations"), *columns)


QUERIES = {
    f.__name__: f
    for f in (
        op1_lm_scoring, op2_secret_scan, op3_sentencepiece, op4_quality_rules, op5_simhash,
        op6_quality_classifier, op7_warc_revisits, op8_decontamination, op9_rans_output, op10_line_dedup,
        op11_license_scan, op12_periodic_runs, op13_prefix_trie,
    )
}

ORACLE = {
    "op11_license_scan": license_index.oracle(),
    "op13_prefix_trie": turn_trie.ORACLE,
    "op7_warc_revisits": """
WITH payload AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), original AS (
  SELECT digest, min(page_id) AS first_id FROM payload WHERE n >= 100 GROUP BY digest
)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM payload p LEFT JOIN original o ON p.digest = o.digest AND p.n >= 100
""",
    "op10_line_dedup": r"""
WITH masked AS (
  SELECT row_number() OVER () AS r, doc_id, text,
         string_split(text, chr(10)) AS raw,
         string_split(regexp_replace(text, '[^ \t\n\x0B\f\r0-9]*[0-9][^ \t\n\x0B\f\r]*', '<*>', 'g'), chr(10)) AS lines
  FROM documents
), line AS (
  SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i FROM masked WHERE text IS NOT NULL
), token AS (
  SELECT r, i, string_split_regex(trim(translate(line, chr(9) || chr(13) || chr(11) || chr(12), '    '), ' '), ' +') AS w FROM line
), found AS (
  SELECT r, w, list(i) AS places FROM token WHERE w[1] <> '' GROUP BY r, w
), copy AS (  -- documents with one set of lines count once
  SELECT DISTINCT list(w ORDER BY w) AS own FROM found GROUP BY r
), held AS (
  SELECT k, unnest(own) AS w FROM (SELECT row_number() OVER () AS k, own FROM copy)
), template AS (
  SELECT w, len(w) AS n, w[1:3] AS lead, count(*) AS docs FROM held GROUP BY w
), leaf AS (
  SELECT n, lead FROM template GROUP BY n, lead HAVING sum(docs) >= 10 AND count(*) > 1
), spot AS (
  SELECT n, lead, w, unnest(w[4:]) AS token, generate_subscripts(w[4:], 1) AS pos FROM template JOIN leaf USING (n, lead)
), common AS (
  SELECT n, lead, pos, token, count(*) AS c FROM spot GROUP BY n, lead, pos, token HAVING count(*) > 1
), ranked AS (
  SELECT n, lead, w, list({'c': c, 'pos': pos, 'token': token} ORDER BY pos) AS own
  FROM spot JOIN common USING (n, lead, pos, token) GROUP BY n, lead, w
), level AS (
  SELECT n, lead, w, own, unnest(list_distinct(list_transform(own, lambda s: s.c))) AS least FROM ranked
), pattern AS (
  SELECT n, lead, w, list_transform(list_filter(own, lambda s: s.c >= least), lambda s: {'pos': s.pos, 'token': s.token}) AS constant
  FROM level
), wide AS (
  SELECT DISTINCT n, lead, w, constant FROM pattern
  WHERE len(constant) + 3 >= 0.7::DOUBLE * n AND len(constant) + 3 < n
), general AS (
  SELECT n, lead, constant FROM wide JOIN held USING (w) GROUP BY n, lead, constant HAVING count(DISTINCT k) >= 10
), bad AS (
  SELECT w FROM template WHERE docs >= 10
  UNION
  SELECT w FROM wide JOIN general USING (n, lead, constant)
), per_row AS (
  SELECT r, list_sort(flatten(list(places))) AS lost FROM found JOIN bad USING (w) GROUP BY r
)
SELECT doc_id, coalesce(len(raw), 0)::BIGINT AS n_lines, coalesce(len(lost), 0)::BIGINT AS n_dropped,
       coalesce(array_to_string(lost, ','), '') AS dropped,
       sha256(CASE WHEN lost IS NULL THEN text ELSE array_to_string(
         list_transform(list_filter(list_zip(raw, range(len(raw))), lambda z: NOT list_contains(lost, z[2])), lambda z: z[1]), chr(10)) END) AS text_sha256
FROM masked LEFT JOIN per_row USING (r)
""",
}
