"""Benchmark decontamination by spaced-seed hashing, by DataFrame functions alone.

Fixed masks hash the words at some places of a window and ignore the others, so a seed survives substituted words. A hit
is a hash that a document and a benchmark item share; it fixes an alignment of the item with the document, along which
words are compared: the item is found where a window of WINDOW words has at least SHARE of them equal. Words are runs of
letters, marks and figures in lower case.

While the benchmark has at most SEEDS seeds they are broadcast to the scan of the documents; beyond that the documents'
hashes are shuffled to them. A hit whose alignment has a hit one word before is left out, as it would be compared twice.

The masks find any WINDOW words with two of them substituted. Items of LEAST words up to that are cut into one piece more
than the substitutions that SHARE allows, one of which is left whole: short masks without gaps search for the pieces, if
the benchmark has such items.

Defined cases: null and empty texts hold nothing; items of fewer than LEAST words are not searched (they would be found in
clean documents); items between that and WINDOW words are compared as a whole; texts of any length are searched whole, as
one array of word hashes; repeated documents and items are rows of their own; equal (doc_id, item_id) pairs become one with
the best alignment; an empty table on either side gives an empty result; clean() keeps all columns, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, whole_row

#: Compared places of each mask. In any 12 words with two substituted, at least one of the three finds a window.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 2, 4, 6, 7), (0, 2, 3, 6, 7, 8))
WINDOW, SHARE, LEAST = 12, 0.8, 5
#: Masks for the pieces of items shorter than WINDOW.
PIECES = ((0, 1), (0, 1, 2), (0, 1, 2, 3))
#: Seeds of the benchmark (some 50 bytes each) up to which they are broadcast.
SEEDS = 200_000


def word_hashes(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _hash(array: str, at: str, mask: tuple[int, ...]) -> str:
    return f"xxhash64({(MASKS + PIECES).index(mask)}, {', '.join(f'get({array}, {at} + {o})' for o in mask)})"


def _starts(array: str, span: int) -> str:
    return f"CASE WHEN size({array}) >= {span} THEN sequence(0, size({array}) - {span}) ELSE CAST(array() AS array<int>) END"


def benchmark_items(bench: DataFrame) -> DataFrame:
    """_item, item_id and _iw (word hashes) of each item that is searched."""
    items = bench.select("item_id", word_hashes(F.col("text")).alias("_iw")).filter(F.size("_iw") >= LEAST)
    return materialise(items.withColumn("_item", F.monotonically_increasing_id()), "benchmark")


def seeds(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Seeds (_h, _k: mask, _item, _ip: place in the item, _prev: seed before) of MASKS at all places of the items of WINDOW
    words or more, and those of PIECES for the shorter ones."""
    one = lambda k, mask, at: f"named_struct('k', {k}, 'p', {at}, 'h', {_hash('_iw', at, mask)})"
    every = f"flatten(array({', '.join(f'transform({_starts("_iw", m[-1] + 1)}, i -> {one(k, m, "i")})' for k, m in enumerate(MASKS))}))"
    cases = []
    for n in range(LEAST, WINDOW):
        pieces = n - math.ceil(n * SHARE) + 1
        cut = [n * i // pieces for i in range(pieces + 1)]
        masks = [min(PIECES, key=lambda m, size=b - a: (len(m) > size, -len(m))) for a, b in zip(cut, cut[1:])]
        cases.append(f"WHEN {n} THEN array({', '.join(one(PIECES.index(m), m, str(a)) for a, m in zip(cut, masks))})")
    out = []
    for part, expr in ((f"size(_iw) >= {WINDOW}", every), (f"size(_iw) < {WINDOW}", f"CASE size(_iw) {' '.join(cases)} END")):
        found = items.filter(part).select("_item", F.explode_outer(F.expr(expr)).alias("_s")).select(F.col("_s.h").alias("_h"), F.col("_s.k").alias("_k"), "_item", F.col("_s.p").alias("_ip"))
        before = F.lag(F.struct("_h", "_ip")).over(Window.partitionBy("_item", "_k").orderBy("_ip"))
        found = found.filter("_h is not null").withColumn("_b", before).withColumn("_prev", F.when(F.col("_b._ip") == F.col("_ip") - 1, F.col("_b._h"))).drop("_b")
        out.append(materialise(found, "benchmark-seeds"))
    return out[0], out[1]


def _alignments(rows: DataFrame, found: DataFrame, key: list[str], masks: tuple[tuple[int, ...], ...]) -> DataFrame:
    """key, _w, _item and _at (the place in the document of the item's first word) of each alignment that has a hit."""
    # outer: else Spark infers a filter on the arrays and pushes it to where the words are hashed again for each of them
    least = min(m[-1] for m in masks)
    starts = _starts("_w", 1 + least)  # near the end, masks that reach too far hash fewer words and find nothing
    hashes = F.expr(f"concat({', '.join(f'transform({starts}, i -> {_hash("_w", "i", m)})' for m in masks)})")
    place = F.expr(f"CAST(_i % greatest(_n - {least}, 1) AS INT)")
    hit = F.col("_x") == F.col("_h")
    if found.count() <= SEEDS:
        hits = rows.withColumn("_hashes", hashes).select(*key, "_w", F.size("_w").alias("_n"), F.posexplode_outer("_hashes").alias("_i", "_x")).withColumn("_p", place)
        before = F.expr(f"CASE _k {' '.join(f'WHEN {k} THEN {_hash("_w", "(_p - 1)", m)}' for k, m in enumerate(masks))} END")
        first = F.col("_prev").isNull() | (F.col("_p") == 0) | (F.col("_prev") != before)
        hits = hits.join(F.broadcast(found), hit & first)
        return hits.select(*key, "_w", "_item", (F.col("_p") - F.col("_ip")).alias("_at"))
    narrow = rows.withColumn("_hashes", hashes).select(*key, F.size("_w").alias("_n"), F.posexplode_outer("_hashes").alias("_i", "_x")).withColumn("_p", place)
    hits = narrow.join(found, hit).select(*[F.col(k).alias(f"_{k}") for k in key], "_item", (F.col("_p") - F.col("_ip")).alias("_at")).distinct()
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(hits, same).select(*key, "_w", "_item", "_at")


def find(docs: DataFrame, bench: DataFrame, key: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """key, item_id, matched_words (equal words along the best alignment), item_words and doc_word (where the item would begin) of each pair found."""
    key = list(key)
    items = benchmark_items(bench)
    found, short = seeds(items)
    rows = docs.select(*[F.col(k) for k in key], word_hashes(F.col(text_col)).alias("_w"))
    aligned = _alignments(rows, found, key, MASKS)
    if short.head(1):
        aligned = aligned.unionByName(_alignments(rows, short, key, PIECES))
    aligned = aligned.join(items, "_item")
    # one expression, bound once: equal places, then the best window and their sum
    equal = "transform(sequence(0, size(_iw) - 1), j -> CASE WHEN get(_w, _at + j) = get(_iw, j) THEN 1 ELSE 0 END)"
    width = f"least({WINDOW}, size(_iw))"
    best = f"array_max(transform(sequence(1, size(_iw) - {width} + 1), s -> aggregate(slice(e, s, {width}), 0, (a, b) -> a + b)))"
    judged = F.expr(f"get(transform(array({equal}), e -> named_struct('best', {best}, 'n', aggregate(e, 0, (a, b) -> a + b))), 0)")
    aligned = aligned.select(*key, "item_id", "_at", F.size("_iw").alias("_words"), judged.alias("_j"))
    good = aligned.filter(F.col("_j.best") >= F.ceil(F.least(F.lit(WINDOW), "_words") * SHARE))
    one = F.struct(F.col("_j.n").alias("n"), (-F.col("_at")).alias("at"), F.col("_words").alias("words"))
    out = good.withColumn("_one", one).groupBy(*key, "item_id").agg(F.max("_one").alias("_one"))
    return out.select(*key, "item_id", F.col("_one.n").alias("matched_words"), F.col("_one.words").alias("item_words"), (-F.col("_one.at")).alias("doc_word"))


def clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """docs without those in which an item was found."""
    marked = docs.select(whole_row(docs).alias("row"), F.col("doc_id").alias("d"), F.xxhash64("text").alias("x"), F.col("text").alias("t"))
    found = find(marked, bench, ("d", "x"), "t").select(F.col("d").alias("found_d"), F.col("x").alias("found_x")).distinct()
    found = materialise(found, "contaminated")
    same = F.col("d").eqNullSafe(F.col("found_d")) & F.col("x").eqNullSafe(F.col("found_x"))
    return marked.join(found, same, "left_anti").select("row.*")
