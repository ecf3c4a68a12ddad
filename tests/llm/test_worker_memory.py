"""What Python workers, which Spark keeps from stage to stage, hold after and during a task."""

import numpy as np
import pyarrow as pa
from kinspark.llm import common, ngram_join, queries, sentencepiece_codec


def test_workers_forget_chunks_after_a_task(spark):
    docs = spark.createDataFrame([(i, f"words of text {i} " * 3) for i in range(40)], "doc_id long, text string").repartition(4)
    made = sentencepiece_codec.encode_documents(docs, queries.piece_model())
    assert made.count() == made.dropDuplicates(["doc_id"]).count() == 40 and made.agg({"n_tokens": "sum"}).first()[0] > 400

    def known(batches):
        for b in batches:
            held = sum(len(c.known) + len(c.known.old) + len(c.known.fresh) for c in sentencepiece_codec._codecs.values())
            yield pa.RecordBatch.from_arrays([pa.array([held] * b.num_rows, pa.int64()), pa.array([len(sentencepiece_codec._codecs)] * b.num_rows, pa.int64())], names=["held", "codecs"])

    found = spark.range(8, numPartitions=8).mapInArrow(known, "held long, codecs long").collect()
    assert any(r.codecs for r in found) and not any(r.held for r in found)


def test_counts_stop_at_the_greatest_number():
    counts = np.zeros(8, np.uint16)
    for _ in range(3):
        ngram_join._count(counts, np.array([1, 1, 5] + [2] * 30_000, np.uint64))
    assert counts.tolist() == [0, 6, 65535, 0, 0, 3, 0, 0]


def test_rows_and_errors_pass_a_frugal_function():
    def run(batches):
        for b in batches:
            if b == 2:
                raise ValueError(b)
            yield b

    got = common.frugal(run)(iter([0, 1, 2]))
    assert [next(got), next(got)] == [0, 1]
    try:
        next(got)
    except ValueError as e:
        assert e.args == (2,)
    else:
        raise AssertionError
