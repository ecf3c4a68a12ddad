"""Registered linkage queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.functions import metrics, text
from kinspark.operators import blocking, learning
from kinspark.sources import delimited
from kinspark.sources.shared import shared_path
from kinspark.streaming import records

from . import blocking_sql, linkage, linkage_oracle, linkage_sql
from .tables import run_sql, table


def _query(sql: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: run_sql(spark, sf_dir, sql)


def knn_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of each embedding, itself left out."""
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    near = blocking.knn_exact(v, v, 10)
    return near.select("id", "neighbour", F.round("sim", 4).alias("sim"), F.col("rnk").cast("long").alias("rnk"))


def _nation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    a, b = (n.select("n_regionkey", F.col("n_nationkey").alias(k), F.col("n_name").alias(f"{k}_name")) for k in "ab")
    return a.join(b, "n_regionkey").filter("a < b")


def jaro_winkler_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nation_pairs(spark, sf_dir).select("a", "b", F.round(metrics.measure("jaro_winkler", F.col("a_name"), F.col("b_name")), 6).alias("likeness"))


def fuzzy_ratio_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All measures of the distinct part names of the same first word."""
    names = table(spark, sf_dir, "part").select("p_name").distinct().withColumn("first", F.substring_index("p_name", " ", 1))
    pairs = names.withColumnRenamed("p_name", "a").join(names.withColumnRenamed("p_name", "b"), "first").filter("a < b")
    return pairs.select("a", "b", *[metrics.measure(m, F.col("a"), F.col("b")).alias(m) for m in metrics.MEASURES])


def normalize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.country_key(F.col("lang")).alias("ckey"), text.clean(F.col("text")).alias("clean"))


def phonetic_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.lower("n_name")
    return table(spark, sf_dir, "nation").select("n_nationkey", text.soundex(name).alias("soundex"), text.skeleton(name).alias("skeleton"), text.india_phonetic(name).alias("india"))


def id_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its parts, dearest first, as a comma-joined list."""
    s1 = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("s1_id"), F.col("l_partkey").cast("string").alias("rec_id"), F.col("l_extendedprice").alias("score"))
    return delimited.id_lists(s1, pairs)


def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events scored as a stream, with what they are worth of their type's greatest value."""
    events = table(spark, sf_dir, "events")
    top = events.groupBy("event_type").agg(F.max("value").alias("top"))
    base = shared_path(spark, "stream")
    score = lambda s: s.join(top, "event_type", "left").select("event_id", "event_type", F.round(F.col("value") / F.when(F.col("top") != 0, F.col("top")), 6).alias("share"))
    return records.run_available(spark, f"{sf_dir}/events*.parquet", events.schema.simpleString()[7:-1].replace(":", " "), score, f"{base}/out", f"{base}/checkpoint")


def gbt_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold probability that a labelled document is of good quality, from counts over its text."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    n = F.greatest(F.length("text"), F.lit(1))
    rate = lambda p: (n - F.length(F.regexp_replace("text", p, ""))) / n
    words = F.size(F.split("text", " "))
    df = docs.select("doc_id", "quality", F.log1p(n).alias("size"), (n / words).alias("word"), rate("[a-z]").alias("lower"), rate("[A-Z]").alias("upper"), rate("[0-9]").alias("figures"), rate("[^\\w\\s]").alias("signs"))
    features = [c for c in df.columns if c not in ("doc_id", "quality")]
    return learning.out_of_fold(df, "doc_id", "quality", features).select("doc_id", "quality", "fold", "p")


SQL = linkage_sql.QUERIES | blocking_sql.filled(blocking_sql.STANDARD)
QUERIES = {name: _query(sql) for name, sql in (linkage_sql.QUERIES | blocking_sql.filled(blocking_sql.SPARK)).items()}
QUERIES |= {f.__name__: f for f in (knn_exact, jaro_winkler_pairs, fuzzy_ratio_family, normalize_documents, phonetic_keys, id_lists, stream_records, gbt_oof)}
SQL |= {
    "knn_exact": """SELECT id, neighbour, ROUND(sim, 4) AS sim, CAST(rnk AS BIGINT) AS rnk FROM (
  SELECT id, neighbour, sim, ROW_NUMBER() OVER (PARTITION BY id ORDER BY sim DESC, neighbour) AS rnk FROM (
    SELECT a.vec_id AS id, b.vec_id AS neighbour, list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS sim
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) x) y WHERE rnk <= 10""",
    "jaro_winkler_pairs": "SELECT a.n_nationkey AS a, b.n_nationkey AS b, ROUND(jaro_winkler_similarity(a.n_name, b.n_name), 6) AS likeness FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey",
    "id_lists": """SELECT CAST(o_orderkey AS VARCHAR) AS source1_entity_id, COALESCE(l, '') AS matched_entity_ids FROM orders LEFT JOIN (
  SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY p DESC, CAST(l_partkey AS VARCHAR)) AS l
  FROM (SELECT l_orderkey, l_partkey, MAX(l_extendedprice) AS p FROM lineitem GROUP BY l_orderkey, l_partkey) x GROUP BY l_orderkey) y ON l_orderkey = o_orderkey""",
    "stream_records": "SELECT event_id, event_type, ROUND(value / NULLIF(MAX(value) OVER (PARTITION BY event_type), 0), 6) AS share FROM events",
}
QUERIES |= linkage.QUERIES
SQL |= linkage_oracle.SQL
