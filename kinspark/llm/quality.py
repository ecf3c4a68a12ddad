"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Learned filters (a table of weights for each
byte at each place of a window) slide over a chunk; each filter's maximum over the chunk passes a rectifier; the mean and
the maximum over the chunks enter one logistic unit. Training is gradient descent (Adam) in numpy on the driver, on a
sample of labelled rows whose size is bounded by PER_LABEL texts of each label.

Defined cases: null and empty texts are one chunk of padding and get a score; rows without a label only get scores; if a
label has no training rows, the score is the share of the other. Equal texts have equal scores. Of a doc_id that repeats,
training takes the least label and the least text, so the net depends on the rows alone. Texts are scored whole, BLOCK
bytes of chunks at a time. The columns kept go under other names meanwhile, so theirs cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, frugal

#: Labelled texts of each label that training sees at most, and the passes over them.
PER_LABEL, PASSES, BATCH, RATE = 700, 8, 64, 0.01
FILTERS, WIDTH, STRIDE, CHUNK = 12, 6, 2, 256
#: Bytes scored at a time.
BLOCK = 1 << 20


@dataclass
class Net:
    table: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray  # FILTERS
    out: np.ndarray  # 2 FILTERS
    shift: np.ndarray  # 1


def new_net(seed: int = 7) -> Net:
    r = np.random.default_rng(seed)
    return Net(r.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), r.normal(0, 0.2, 2 * FILTERS).astype(np.float32), np.zeros(1, np.float32))


def chunked(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all chunks (chunks x CHUNK + overlap) and the first chunk of each text."""
    over = WIDTH - STRIDE
    counts = np.array([max(1, -(-len(t) // CHUNK)) for t in texts])
    padded = b"".join(t.ljust(int(n) * CHUNK, b"\0") + bytes(over) for t, n in zip(texts, counts, strict=True))
    flat = np.frombuffer(padded, np.uint8)
    first = np.concatenate([[0], np.cumsum(counts)])
    text_of = np.repeat(np.arange(len(texts)), counts)
    starts = (np.arange(first[-1]) * CHUNK + text_of * over).astype(np.int64)
    return flat[starts[:, None] + np.arange(CHUNK + over)], first


def pooled(net: Net, chunks: np.ndarray, places: bool = False):
    """Each filter's maximum over each chunk, and where it is."""
    n = (CHUNK - STRIDE) // STRIDE + 1
    total = np.take(net.table[0], chunks[:, 0 : n * STRIDE : STRIDE], axis=0)
    for w in range(1, WIDTH):
        total += np.take(net.table[w], chunks[:, w : w + n * STRIDE : STRIDE], axis=0)
    if places:
        where = total.argmax(axis=1)
        return np.take_along_axis(total, where[:, None, :], 1)[:, 0, :] + net.bias, where * STRIDE
    return total.max(axis=1) + net.bias


def features(hidden: np.ndarray, first: np.ndarray) -> np.ndarray:
    counts = np.diff(first)[:, None]
    return np.concatenate([np.add.reduceat(hidden, first[:-1], axis=0) / counts, np.maximum.reduceat(hidden, first[:-1], axis=0)], axis=1)


def score(net: Net, texts: list[bytes]) -> np.ndarray:
    """Probability of label 1 for each text, whatever its length."""
    out, i = np.empty(len(texts)), 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= BLOCK):
            size += len(texts[j])
            j += 1
        chunks, first = chunked(texts[i:j])
        step = BLOCK // CHUNK
        hidden = np.concatenate([np.maximum(pooled(net, chunks[k : k + step]), 0) for k in range(0, len(chunks), step)])
        z = (features(hidden, first) @ net.out + net.shift).astype(np.float64)
        out[i:j] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        i = j
    return out


def train(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> Net:
    net, r = new_net(seed), np.random.default_rng(seed)
    params = [net.table, net.bias, net.out, net.shift]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(PASSES):
        order = r.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            chunks, first = chunked([texts[i] for i in pick])
            raw, where = pooled(net, chunks, places=True)
            hidden = np.maximum(raw, 0)
            x = features(hidden, first)
            z = x @ net.out + net.shift
            g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[pick]) / len(pick)).astype(np.float32)
            counts = np.diff(first)
            owner = np.repeat(np.arange(len(pick)), counts)
            gx = g[:, None] * net.out
            gh = gx[owner, :FILTERS] / counts[owner, None]
            top = hidden == x[owner, FILTERS:]
            gh = gh + gx[owner, FILTERS:] * top / np.maximum(1, np.add.reduceat(top, first[:-1], axis=0))[owner]
            gh = np.where(raw > 0, gh, 0).astype(np.float32)
            grads = [np.zeros_like(net.table), gh.sum(0), x.T @ g, g.sum(keepdims=True)]
            rows, cols = np.arange(len(chunks))[:, None], np.arange(FILTERS)
            for w in range(WIDTH):
                flat = chunks[rows, where + w].astype(np.int64) * FILTERS + cols
                grads[0][w] = np.bincount(flat.ravel(), gh.ravel(), 256 * FILTERS).reshape(256, FILTERS)
            step += 1
            for k, (p, d) in enumerate(zip(params, grads, strict=True)):
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.99 * v[k] + 0.01 * d * d
                p -= (RATE * m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def fold(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def training_rows(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> list[tuple[bytes, int]]:
    """At most per_label labelled texts of each label outside the held-out fold, chosen by a hash of doc_id."""
    hashed = F.xxhash64(F.lit("quality"), "doc_id")
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("doc_id is not null and quality in (0, 1)").filter(fold() != 0).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = [r for y in (0, 1) for r in known.filter(F.col("quality") == y).select("doc_id", "quality", hashed.alias("h")).orderBy("h", "doc_id").limit(per_label).collect()]
    if not chosen:
        return []
    of = {r[0]: r[1] for r in chosen}
    rows = docs.filter(F.col("doc_id").isin(list(of))).groupBy("doc_id").agg(F.min("text").alias("text")).collect()
    return [((r[1] or "").encode(), of[r[0]]) for r in sorted(rows, key=lambda r: r[0])]


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Net | float:
    """A net, or the constant share of label 1 where only one label (or none: 1) is known."""
    rows = training_rows(docs, labels, per_label)
    y = np.array([r[1] for r in rows], np.float32)
    if not rows or y.min() == y.max():
        return float(y.mean()) if rows else 1.0
    return train([r[0] for r in rows], y)


def score_documents(df: DataFrame, net: Net | float, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep (the text may be among it) and score of each row. Only the text enters the score."""
    arrow_limits(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(net)  # tens of kilobytes
    src = df.select(*[F.col(k).alias(f"c{i}") for i, k in enumerate(keep)], *([] if text_col in keep else [F.col(text_col).alias("t")]))
    text = f"c{keep.index(text_col)}" if text_col in keep else "t"
    schema = src.drop("t").withColumn("s", F.lit(0.0)).schema
    for f in schema.fields:
        f.nullable = True

    def run(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(text).to_pylist()]
            got = np.full(len(texts), shared.value) if isinstance(shared.value, float) else score(shared.value, texts)
            yield pa.RecordBatch.from_arrays([*(batch.column(f"c{i}") for i in range(len(keep))), pa.array(got, pa.float64())], names=schema.fieldNames())

    return src.mapInArrow(frugal(run), schema).toDF(*keep, "score")
