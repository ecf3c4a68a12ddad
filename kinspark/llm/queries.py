"""The corpus operators' queries, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fingerprints, html_text, ngram_join, pii, quality, secrets_scan, sentencepiece_codec, sharding, warc
from .common import table

#: Name of the vocabulary file among the public tokenizers.
PIECES = "piece_bpe_32k.model"


def piece_model(path: str | None = None) -> bytes:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(PIECES)
    with open(path, "rb") as f:
        return f.read()


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"), piece_model(), with_ids=False)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents"), words=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_documents(docs, net)
    return scored.select("doc_id", (quality.fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.scan_documents(table(spark, sf_dir, "documents")).drop("redacted")


#: The key of the surrogates; who runs the query on data of their own gives a secret one.
PII_KEY = "kinspark-demonstration-key"


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_documents(table(spark, sf_dir, "documents"), PII_KEY)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_sharding, op3_sentencepiece, op4_ngram_join, op5_decontaminate, op6_quality, op7_html, op8_secrets, op9_pii, op10_fingerprints)}
SQL = {
    "op1_warc": """
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN revisit THEN top END AS refers_to
FROM (SELECT page_id, body, top, octet_length(encode(body)) >= 1000 AND page_id < top AS revisit
      FROM (SELECT page_id, coalesce(html, '') AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages))
""",
    "op4_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3]) END) AS s
  FROM w),
n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
link AS (
  SELECT a.r AS x, b.r AS y FROM sh a JOIN sh b ON a.s = b.s AND a.r <> b.r JOIN n p ON p.r = a.r JOIN n q ON q.r = b.r
  WHERE 100 * least(p.n, q.n) >= 85 * greatest(p.n, q.n)
  GROUP BY a.r, b.r, p.n, q.n HAVING 185 * count(*) >= 85 * (p.n + q.n)),
reach(r, t) AS (SELECT r, r FROM w UNION SELECT reach.r, link.y FROM reach JOIN link ON link.x = reach.t)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(v.doc_id) AS component_id
FROM w LEFT JOIN n ON n.r = w.r JOIN reach ON reach.r = w.r JOIN w v ON v.r = reach.t GROUP BY w.r, w.doc_id
""",
}
