"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Equal n-gram sets are one row of the matrix (a node). The product's entries are formed only where they can reach the
similarity. Columns are ordered by how often they occur (counts by hash bucket, over all documents), rarest first; a row
of n entries that must share at least ceil(t n) of them with a partner shares one of its first n - ceil(t n) + 1, so only
these enter the search for partners. Sizes bound the rest: a partner has between t n and n / t entries, and of two rows,
what the one whose search columns end first shares with the other is at most their common search columns and its remaining
ones. Only pairs that can so reach t / (1 + t) (n + m) go on. They are gathered in blocks of rows with one pivot; a block's
overlap counts are accumulated as a product of its whole rows with the pivot's column set, and pairs below are discarded.

Groups are not expanded into all pairs. First every row of a column is paired with the column's pivot alone (the row that
shares most of its own columns: of edited copies, the original), and links are closed to components. Then, of the rows
that share a pivot, those that lie in different components are compared in products of blocks of bounded size, spread over
tasks: first of their search columns, then of the whole rows of those that have a possible partner. One link of each two
components leaves a product. No link between components is lost, so components are exact; links inside a component
that are not needed to connect it are not formed, and not counted. Rows that share a pivot and lie in many components
without a link among them cost the square of their number in search columns, spread over tasks.

Words are runs of other characters than space, tab, line feed, vertical tab, form feed and carriage return, in lower case
for A-Z alone; n-grams, sets and nodes are 64-bit hashes (of words: polynomials, which protect from chance, not from words
of a thousand letters and more made up to collide). Texts are hashed whole, whatever their length. Defined cases: null and
empty texts have no n-grams and are linked with nothing; texts of fewer words have one, the whole sequence; repeated rows
and null doc_ids are rows of their own (a component's id is its least doc_id that is not null); an empty table gives an
empty result; further columns, of whatever names, stay out of the work.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, done_with, frugal, materialise, small, whole_row

#: Hash buckets of the n-gram counts, their slices, bytes hashed at a time, and n-grams of a block's rows that are aimed at.
BUCKETS, SLICES, PIECE, BLOCK = 1 << 24, 64, 1 << 20, 400_000
#: Rows of a product at most, and of a block with its pivot.
ROWS, STAR = 800, 64
#: Documents needed for a product, or dropped as copies, up to which their keys are broadcast to the scan of the texts; beyond,
#: both are shuffled.
KEYS = 500_000
#: Columns up to which a table of them (a few longs each) is broadcast to the search entries; beyond, both are shuffled.
COLUMNS = 2_000_000
BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            t = np.full(n, base, np.uint64)
            t[0] = 1
            _powers[k] = np.multiply.accumulate(t)
    return _powers


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _factor(k: int) -> int:
    """A fixed random odd factor of the k-th word of an n-gram: factors in a simple progression would let orders collide."""
    return int.from_bytes(hashlib.sha256(f"factor {k}".encode()).digest()[:8], "big") | 1


def _hashed(texts: list[bytes], words: int) -> list[np.ndarray]:
    sizes = np.array([len(t) + 1 for t in texts])
    raw = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    power, inverse = _power_tables(max(len(raw), PIECE) + 1)
    inside = ~_SPACE[raw]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[::2], edge[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)])])
    word = _mix((sums[end] - sums[start]) * inverse[start])
    first = np.searchsorted(start, begins)
    run = np.zeros(max(0, len(word) - words + 1), np.uint64)
    for k in range(words):
        run += word[k : len(word) - words + 1 + k] * np.uint64(_factor(k))
    run = _mix(run)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(run[a : b - words + 1]))
        elif b > a:
            h = sum(int(w) * _factor(k) for k, w in enumerate(word[a:b])) + (b - a)
            out.append(_mix(np.array([h % (1 << 64)], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def shingle_sets(texts: list[bytes | None], words: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's n-grams."""
    out, i = [], 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or b"") < PIECE):
            size += len(texts[j] or b"") + 1
            j += 1
        out += _hashed([t or b"" for t in texts[i:j]], words)
        i = j
    return out


def node_of(s: np.ndarray) -> int:
    """A set's hash."""
    total = _mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(s))
    return int(_mix(np.array([total], np.uint64)).view(np.int64)[0])


def _arrow(batch: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(batch[f.name], f.type) for f in schema], schema=schema)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("x"), F.col("text").cast("binary").alias("t"))


def _count(counts: np.ndarray, buckets: np.ndarray) -> None:
    """Adds one for each of the buckets, to the greatest number that counts can hold."""
    at, more = np.unique(buckets, return_counts=True)
    counts[at] = np.minimum(counts[at] + more, np.iinfo(counts.dtype).max)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """A row of each document (doc_id, x: hash of the text, n, node) and rows of counts by bucket (slice, counts)."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("slice", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        import zstandard

        counts = np.zeros(BUCKETS, np.uint16)
        for batch in batches:
            sets = shingle_sets(batch.column("t").to_pylist(), words)
            if sets:
                _count(counts, np.concatenate(sets) & np.uint64(BUCKETS - 1))
            n = len(sets)
            yield _arrow({"doc_id": batch.column("doc_id"), "x": batch.column("x"), "n": [len(s) for s in sets], "node": [node_of(s) if len(s) else None for s in sets], "slice": [None] * n, "counts": [None] * n}, schema)
        packed = [zstandard.ZstdCompressor(level=3).compress(c.tobytes()) for c in counts.reshape(SLICES, -1)] if counts.any() else []
        n = len(packed)
        yield _arrow({"doc_id": [None] * n, "x": [None] * n, "n": [None] * n, "node": [None] * n, "slice": range(n), "counts": packed}, schema)

    return _texts(docs).mapInArrow(frugal(run), "doc_id long, x long, n int, node long, slice int, counts binary")


def _rank(counts: np.ndarray) -> np.ndarray:
    """Counts on a scale of 256 steps: exact to 31, then by sevenths of a doubling."""
    return np.where(counts < 32, counts, np.minimum(255, 32 + 7 * np.log2(np.maximum(counts, 32) / 32))).astype(np.uint8)


def _column_counts(sets: DataFrame) -> np.ndarray:
    """The sums of the tasks' counts on a scale of 256 steps: a byte for each bucket, whatever the input. Slices are added up apart."""

    def run(batches):
        import zstandard

        total = {}
        for batch in batches:
            for k, c in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                add = np.frombuffer(zstandard.ZstdDecompressor().decompress(c), np.uint16).astype(np.uint64)
                total[k] = total[k] + add if k in total else add
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array([_rank(c).tobytes() for c in total.values()], pa.binary())], names=["slice", "counts"])

    rows = sets.filter("slice is not null").select("slice", "counts").repartition(SLICES, "slice").mapInArrow(frugal(run), "slice int, counts binary").collect()
    out = np.zeros((SLICES, BUCKETS // SLICES), np.uint8)
    for k, c in rows:
        out[k] = np.frombuffer(c, np.uint8)
    return out.ravel()


def _postings(docs: DataFrame, counts: np.ndarray, words: int, percent: int) -> DataFrame:
    """(h, node, n, wr, wh): the rarest columns of each row, as many as partners can't avoid, and the last of them in the
    order (its rank, then its hash). A task names a node once."""
    order = docs.sparkSession.sparkContext.broadcast(counts)
    schema = pa.schema([("h", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("wr", pa.int32()), ("wh", pa.int64())])

    def run(batches):
        seen = set()
        for batch in batches:
            parts = []
            for s in shingle_sets(batch.column("t").to_pylist(), words):
                if len(s) and (node := node_of(s)) not in seen:
                    seen.add(node)
                    n = len(s)
                    prefix = n + (-percent * n // 100) + 1
                    rank = order.value[s & np.uint64(BUCKETS - 1)]
                    rare = np.lexsort((s.view(np.int64), rank))[:prefix]
                    parts.append((s[rare].view(np.int64), node, n, int(rank[rare[-1]])))
            if parts:
                lens = [len(p[0]) for p in parts]
                each = lambda values, kind: np.repeat(np.array(values, kind), lens)
                yield _arrow({"h": np.concatenate([p[0] for p in parts]), "node": each([p[1] for p in parts], np.int64), "n": each([p[2] for p in parts], np.int32), "wr": each([p[3] for p in parts], np.int32), "wh": each([p[0][-1] for p in parts], np.int64)}, schema)

    return _texts(docs).mapInArrow(frugal(run), "h long, node long, n int, wr int, wh long")


def _prefix_of(n: Column, percent: int) -> Column:
    return n - F.ceil(n * percent / 100) + 1


def _near(a: str, b: str, percent: int):
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent) & (F.col(a) > 0)


def _full_rows(docs: DataFrame, sets: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, s: sorted n-gram hashes) of the nodes asked for, from the texts again; a task names a node once."""
    keys = materialise(sets.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("x").alias("x")).select("x").distinct(), "ngram-keys")
    keys = F.broadcast(keys) if keys.count() <= KEYS else keys

    def rows(batches):
        seen = set()
        for batch in batches:
            got = [(node_of(s), s.tobytes()) for s in shingle_sets(batch.column("t").to_pylist(), words) if len(s)]
            got = [g for g in got if g[0] not in seen and not seen.add(g[0])]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.binary())], names=["node", "s"])

    return _texts(docs).join(keys, "x", "left_semi").mapInArrow(frugal(rows), "node long, s binary")


def _by_group(df: DataFrame, keys: list[str], product, schema: str) -> DataFrame:
    """product, a function of a table to a table of schema, of the rows of each group in turn. Groups are bounded by those
    who make them; many small ones share a batch, which grouped Arrow functions would not let them."""

    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            cols = [t.column(k).to_numpy() for k in keys]
            ends = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1).tolist()] if t.num_rows else [0]
            out = [product(t.slice(a, b - a)) for a, b in zip(ends, ends[1:])]
            held = t.slice(ends[-1])
            if out:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
        if held is not None and held.num_rows:
            yield from product(held).to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(frugal(run), schema)


def _possible(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and common search columns allow the similarity, with bn: b's size, and an: a's."""
    side = lambda x: rows.select(F.col("node").alias(x), F.col("hs").alias(f"{x}h"), F.col("n").alias(f"{x}n"), F.col("wr").alias(f"{x}r"), F.col("wh").alias(f"{x}w"))
    met = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    first = F.when((F.col("ar") < F.col("br")) | (F.col("ar") == F.col("br")) & (F.col("aw") <= F.col("bw")), F.col("an")).otherwise(F.col("bn"))
    most = F.size(F.array_intersect("ah", "bh")) + first - _prefix_of(first, percent)
    return met.filter((100 + percent) * most >= percent * (F.col("an") + F.col("bn"))).select("a", "b", "an", "bn")


def _verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The candidate pairs (a: pivot, an: its size, b, bn) that are links, by blocked products of full rows with their pivots."""
    load = pairs.groupBy("a").agg(F.sum("bn").alias("load"), F.count("*").alias("c"), F.max("an").alias("an"))
    # a pivot's row goes with each of its blocks, so blocks of a large pivot are larger
    size = F.greatest(F.ceil(F.col("load") / F.greatest(F.lit(BLOCK // 8), 4 * F.col("an"))), F.ceil(F.least(F.col("c") / STAR, F.col("load") / (4 * F.col("an")))))
    load = load.select("a", F.greatest(size, F.lit(1)).alias("blocks"))
    blocks = pairs.select("a", "b").join(load, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("k"))
    blocks = materialise(blocks, "ngram-blocks")
    wanted = blocks.select("a", "k", F.col("b").alias("node")).unionByName(blocks.select("a", "k", F.col("a").alias("node")).distinct())
    full = _full_rows(docs, sets, blocks.select(F.explode(F.array("a", "b")).alias("node")).distinct(), words)
    members = full.join(small(materialise(wanted, "ngram-wanted"), KEYS), "node")

    def product(table: pa.Table) -> pa.Table:
        pivot = table.column("a")[0].as_py()
        by = dict(zip(table.column("node").to_pylist(), table.column("s").to_pylist(), strict=True))  # copies met in two tasks are one
        columns = np.frombuffer(by.pop(pivot), np.uint64)
        out = []
        if by:
            entries = [np.frombuffer(s, np.uint64) for s in by.values()]
            sizes = np.array([len(e) for e in entries])
            flat = np.concatenate(entries)
            at = np.minimum(np.searchsorted(columns, flat), len(columns) - 1)
            overlap = np.add.reduceat((columns[at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            good = (100 + percent) * overlap >= percent * (sizes + len(columns))
            out = [b for b, g in zip(by, good.tolist(), strict=True) if g]
        return pa.table({"a": pa.array([pivot] * len(out), pa.int64()), "b": pa.array(out, pa.int64())})

    return _by_group(members.select("a", "k", "node", "s"), ["a", "k"], product, "a long, b long")


def _overlaps(rows: list[np.ndarray]) -> np.ndarray:
    """How many entries each two rows share: the product of their block of the incidence matrix with itself."""
    sizes = np.array([len(r) for r in rows])
    _, column, times = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    shared = times > 1  # other columns add nothing to the product
    number = np.cumsum(shared) - 1
    row = np.repeat(np.arange(len(rows)), sizes)[shared[column]]
    column = number[column[shared[column]]]
    by_column = np.argsort(column, kind="stable")
    row, column = row[by_column], column[by_column]
    overlap = np.zeros((len(rows), len(rows)))
    width = max(1, min(int(number[-1]) + 1, PIECE // len(rows)))
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, (at, at + width))
        part = np.zeros((len(rows), width), np.float32)  # counts under 2^24 are exact, and summed in doubles
        part[row[lo:hi], column[lo:hi] - at] = 1
        overlap += part @ part.T
    return overlap.astype(np.int64)


def _dealt(members: DataFrame) -> DataFrame:
    """(g, i, j, node, root): products (i, j) of two blocks of each group of members (g, node, n, root), of at least two
    roots each. A group's rows are dealt to blocks of bounded size, those of its commonest root apart from the others; the
    products of two blocks are formed unless both are of that root."""
    by_root = members.groupBy("g", "root").agg(F.count("*").alias("c"), F.sum("n").alias("load"))
    size = by_root.groupBy("g").agg(F.max(F.struct("c", "load", "root")).alias("top"), F.sum("c").alias("c"), F.sum("load").alias("load"))
    blocks = lambda c, load: F.greatest(F.ceil(F.col(c) / (ROWS // 2)), F.ceil(F.col(load) / (BLOCK // 2))).cast("int")
    size = size.select("g", F.col("top.root").alias("major"), (F.col("c") - F.col("top.c")).alias("rc"), (F.col("load") - F.col("top.load")).alias("rl"), F.col("top.c").alias("mc"), F.col("top.load").alias("ml"), "c", "load")
    size = size.withColumn("one", (F.col("c") <= ROWS) & (F.col("load") <= BLOCK)).withColumn("few", F.when(F.col("one"), 1).otherwise(blocks("rc", "rl"))).withColumn("many", F.when(F.col("one"), 0).otherwise(blocks("mc", "ml")))
    placed = members.join(materialise(size.select("g", "major", "one", "few", "many"), "ngram-groups"), "g")
    hashed = F.xxhash64("node", "g")
    minor = F.col("one") | (F.col("root") != F.col("major"))
    placed = placed.withColumn("k", F.when(minor, F.pmod(hashed, F.col("few"))).otherwise(F.col("few") + F.pmod(hashed, F.greatest("many", F.lit(1)))).cast("int"))
    partners = F.when(minor, F.sequence(F.lit(0), F.col("few") + F.col("many") - 1)).otherwise(F.sequence(F.lit(0), F.col("few") - 1))
    dealt = placed.select("g", "node", "root", "k", F.explode(partners).alias("o"))
    return dealt.select("g", F.least("k", "o").alias("i"), F.greatest("k", "o").alias("j"), "node", "root")


def _survivors(dealt: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The dealt rows that have a possible partner of another root in their product, by a product of search columns."""

    def product(table: pa.Table) -> pa.Table:
        n, wr, wh, root = (table.column(c).to_numpy() for c in ("n", "wr", "wh", "root"))
        order = np.lexsort((wh, wr))
        hs = table.column("hs").combine_chunks()
        flat, ends = hs.flatten().to_numpy(), np.concatenate([[0], np.cumsum(hs.value_lengths().to_numpy())])
        most = _overlaps([flat[ends[i] : ends[i + 1]] for i in order])
        n, root = n[order].astype(np.int64), root[order]
        rest = -(-percent * n // 100) - 1  # entries behind the search columns, of the row whose search columns end first
        good = np.triu((100 + percent) * (most + rest[:, None]) >= percent * (n[:, None] + n), 1) & (root[:, None] != root)
        return table.select(["g", "i", "j", "node", "root"]).take(order[good.any(axis=0) | good.any(axis=1)])

    met = dealt.join(rows, "node").select("g", "i", "j", "node", "root", "n", "wr", "wh", "hs")
    return _by_group(met, ["g", "i", "j"], product, "g long, i int, j int, node long, root long")


def _tiles(docs: DataFrame, sets: DataFrame, dealt: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): two roots of which rows of a product are linked, once for each product."""
    full = _full_rows(docs, sets, dealt.select("node").distinct(), words)

    def product(table: pa.Table) -> pa.Table:
        by = {n: (r, s) for n, r, s in zip(*(table.column(c).to_pylist() for c in ("node", "root", "s")), strict=True)}
        roots = np.array([x[0] for x in by.values()], np.int64)
        rows = [np.frombuffer(x[1], np.uint64) for x in by.values()]
        sizes = np.array([len(r) for r in rows])
        good = (100 + percent) * _overlaps(rows) >= percent * (sizes[:, None] + sizes)
        a, b = np.nonzero(good & (roots[:, None] < roots))
        ends = np.unique(np.stack([roots[a], roots[b]]), axis=1)
        return pa.table({"a": ends[0], "b": ends[1]})

    return _by_group(full.join(small(dealt, KEYS), "node").select("g", "i", "j", "node", "root", "s"), ["g", "i", "j"], product, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge (a, b): root is the least node reachable. Edges are rewired towards the
    least neighbour, from larger and from smaller neighbours in turn, until all are stars; no step gathers a group."""
    e = materialise(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u != v").distinct(), "edges")
    while True:
        # stars around their least node: no node has two neighbours below, or one that has such a neighbour itself
        ends = e.select(F.col("v").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select("u", F.lit(0), F.lit(1)).distinct().toDF("x", "up", "down"))
        if not ends.groupBy("x").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).filter("up > 1 or up > 0 and down > 0").head(1):
            return e.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(e.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
        for both in (True, False):
            near = e.select(F.col("v").alias("x"), F.col("u").alias("y"))
            near = near.unionByName(e.select(F.col("u").alias("x"), F.col("v").alias("y"))) if both else near
            least = near.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
            met = near.join(least, "x")
            # larger neighbours move to the least one; then the smaller ones, and the node itself, do
            moved = met.filter("y > x").select(F.col("y").alias("v"), F.col("m").alias("u")) if both else met.select(F.col("y").alias("v"), F.col("m").alias("u")).unionByName(least.select(F.col("x").alias("v"), F.col("m").alias("u")))
            last, e = e, materialise(moved.filter("u != v").distinct(), "edges")
            done_with(last)


def similar(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, x (hash of the text), n_shingles, component_id and root of every row of docs (doc_id, text). Rows link when
    100 x intersection >= percent x union; root names the component."""
    arrow_limits(docs.sparkSession)
    made = materialise(_sets(docs, words), "ngram-sets")
    counts = _column_counts(made)
    sets = made.filter("slice is null").select("doc_id", "x", "n", "node")
    postings = materialise(_postings(docs, counts, words, percent), "ngram-postings")
    # columns of at least two rows
    shared = postings.groupBy("h").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo != hi").select("h")
    shared = materialise(shared, "ngram-columns")
    rows = postings.join(small(shared, COLUMNS), "h", "left_semi").groupBy("node").agg(F.collect_set("h").alias("hs"), *(F.max(c).alias(c) for c in ("n", "wr", "wh")))
    rows = materialise(rows, "ngram-rows")
    done_with(postings, shared)
    # a column's pivot is the row that shares the largest part of its own search columns: of edited copies, the original
    live = rows.select(F.explode("hs").alias("h"), "node", "n", (F.size("hs") / _prefix_of(F.col("n"), percent)).alias("part"))
    pivot = live.groupBy("h").agg(F.max(F.struct("part", "node", "n")).alias("p")).select("h", F.col("p.node").alias("a"), F.col("p.n").alias("an"))
    pivot = materialise(pivot, "ngram-pivots")
    live = materialise(live.drop("part").join(small(pivot, COLUMNS), "h").filter("node != a"), "ngram-live")
    done_with(pivot)
    pivots = materialise(live.filter(_near("an", "n", percent)).select("a", F.col("node").alias("b")).distinct(), "ngram-pairs")
    pivots = materialise(_possible(pivots, rows, percent), "ngram-possible")
    links = materialise(_verified(docs, sets, pivots, words, percent), "ngram-links")
    roots = materialise(components(links), "ngram-roots")
    # columns whose rows, but for the pivot, lie in several components: what no pivot has decided
    known = live.join(roots, "node", "left").select("h", "a", "node", "n", F.coalesce("root", "node").alias("root"))
    # partners differ in size by one class at most, so each is in a class that both are dealt to
    step = F.floor(F.log("n") / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int") if percent < 100 else F.col("n")
    known = materialise(known.withColumn("c", F.explode(F.array(step, step + 1))), "ngram-known")
    done_with(live)
    undecided = known.groupBy("h", "c").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("h", "c")
    undecided = materialise(undecided, "ngram-undecided")
    members = known.join(small(undecided, COLUMNS), ["h", "c"], "left_semi").select(F.xxhash64("a", "c").alias("g"), "node", "n", "root").distinct()
    members = materialise(members, "ngram-members")
    done_with(known, undecided)
    dealt = materialise(_survivors(materialise(_dealt(members), "ngram-tiles"), rows, percent), "ngram-survivors")
    if dealt.head(1):
        joined = materialise(components(_tiles(docs, sets, dealt, words, percent)), "ngram-joined").select(F.col("node").alias("root"), F.col("root").alias("to"))
        alone = joined.join(roots, "root", "left_anti").select(F.col("root").alias("node"), F.col("to").alias("root"))
        roots = materialise(roots.join(joined, "root", "left").select("node", F.coalesce("to", "root").alias("root")).unionByName(alone), "ngram-roots")
    done_with(rows)
    # ids: a set's least doc_id, then a component's
    own = sets.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    own = materialise(own, "ngram-own")
    linked = own.join(roots, "node")
    ids = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(ids, "root").select("node", "root", "component_id")
    alone = own.filter("copies > 1").join(roots, "node", "left_anti").select("node", F.col("node").alias("root"), F.col("least").alias("component_id"))
    named = materialise(linked.unionByName(alone), "ngram-named")
    full = sets.filter("node is not null").join(named, "node", "left")
    out = full.select("doc_id", "x", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("root", "node").alias("root"))
    empty = sets.filter("node is null").select("doc_id", "x", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("root"))
    return out.unionByName(empty)


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component: that of the least doc_id (a null one last). Rows without n-grams all stay."""
    found = materialise(similar(docs, words, percent), "ngram-similar")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "x"))
    groups = found.filter("root is not null").groupBy("root").agg(F.count("*").alias("rows"), least.alias("kept")).filter("rows > 1")
    groups = materialise(groups.select("root", F.col("kept.doc_id").alias("k_id"), F.col("kept.x").alias("k_x")), "ngram-groups")
    in_groups = found.join(groups, "root").select("doc_id", "x", (F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("x") == F.col("k_x"))).alias("kept"))
    out = materialise(in_groups.groupBy("doc_id", "x").agg(F.max("kept").alias("kept"), F.count("*").alias("rows")), "ngram-decided")
    marked = docs.select(whole_row(docs).alias("row"), F.col("doc_id").cast("long").alias("d"), F.xxhash64("text").alias("x"))
    key = lambda t: t.select(F.col("doc_id").alias("to_d"), F.col("x").alias("to_x"))
    same = F.col("d").eqNullSafe(F.col("to_d")) & (F.col("x") == F.col("to_x"))
    repeated = out.filter("kept and rows > 1")
    stay = marked.join(small(key(out.filter("not kept or rows > 1")), KEYS), same, "left_anti")
    if repeated.head(1):  # rows that repeat both doc_id and text: one of them
        stay = stay.unionByName(marked.join(small(key(repeated), KEYS), same, "left_semi").dropDuplicates(["d", "x"]))
    return stay.select("row.*")
