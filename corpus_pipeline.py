"""Corpus pipeline: quality, near copies, benchmark leaks, secrets, tokens. Each stage reads what the one before wrote."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.llm import common, decontaminate, ngram_join, quality, queries, secrets_scan, sentencepiece_codec

#: Score under which a document is rejected.
REJECT_BELOW = 0.3


#: Scratch tables of the stage that was called last.
_scratch: list[str] = []


def _stage(f: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """A stage begins when the one before has been written: that one's own scratch tables are no longer read."""

    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.delete(spark, _scratch)
        with common.scratch(_scratch):
            return f(spark, docs, sf_dir)

    return run_stage


@_stage
def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is REJECT_BELOW or more; the net is trained on sf_dir's labelled documents."""
    net = quality.fit(docs, common.table(spark, sf_dir, "labels"))
    scored = quality.score_documents(docs, net, keep=tuple(docs.columns))
    return scored.filter(F.col("score") >= REJECT_BELOW).select(*docs.columns)


@_stage
def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return ngram_join.deduplicate(docs, words=5, percent=80)


@_stage
def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


@_stage
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by their kind, n_chars as of the new text."""
    return secrets_scan.redact_documents(docs)


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ids of every document."""
    return sentencepiece_codec.encode_documents(docs, queries.piece_model())


STAGES = [
    ("quality classifier", classify),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", remove_leaks),
    ("secret scans", redact_secrets),
    ("SentencePiece encoding", encode),
]
#: The classifier and the codec can't be expressed in SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over sf_dir's documents, each written as Parquet to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    base, read = common.shared_path(spark, "pipeline"), []
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        common.delete(spark, read)
        docs, read = spark.read.parquet(f"{base}/{k}"), [f"{base}/{k}"]
    common.delete(spark, _scratch)
    return docs
