"""Document fingerprints: threshold-scaled sketches of word shingles, by DataFrame functions alone.

A text's shingles (three words; all words where there are fewer) are hashed, and every hash below a fixed fraction of the
hash range is kept, so sketches of very unequal texts compare, and the sketch of a union is merged() of the sketches. A
text whose shingles all lie above keeps its least hash in their stead, so only a text without words has an empty
fingerprint; such a stand-in gives way as soon as a hash below is there.

Defined cases: null is the empty text; texts are fingerprinted whole, whatever their length; likeness is 1 for two empty
fingerprints and 0 for one; containment of a stand-in in a sketch of kept hashes is unknown (null); the next document of
the last, in descending doc_id, is the first (of one document: itself); null doc_ids come last; equal doc_ids follow a
hash of their texts, repeated rows are interchangeable; an empty table gives an empty result; other columns than doc_id
and text are left out, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Words of a shingle, and the kept part of the hash range as a power of 1/2.
WORDS, HALVINGS = 3, 2
#: Rows that a bucket of neighbours aims at, the buckets at most (beyond, they grow, and are sorted on disk), and how many
#: rows a bucket the sample has from which their bounds come.
NEIGHBOURS, BUCKETS, SAMPLE = 500, 65_536, 4


def sketch(text: Column, words: int = WORDS, halvings: int = HALVINGS) -> Column:
    """Sorted distinct hashes (int) of the text's sketch."""
    hashes = F.transform(F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != ""), lambda w: F.xxhash64(w))
    return F.transform(F.array(hashes), lambda h: _kept(h, words, halvings))[0]


def _kept(hashes: Column, words: int, halvings: int) -> Column:
    n = F.size(hashes)
    starts = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - words, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    all_of = F.transform(starts, lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(hashes, i + k) for k in range(words)]), 33).cast("int"))
    # 31-bit hashes: those under 2^(31 - halvings) are kept
    return F.transform(F.array(all_of), lambda a: _below(a, 1 << (31 - halvings)))[0]


def _below(a: Column, limit: int) -> Column:
    low = F.sort_array(F.array_distinct(F.filter(a, lambda v: v < limit)))
    return F.when((F.size(low) == 0) & (F.size(a) > 0), F.array(F.array_min(a))).otherwise(low)


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda v: F.lpad(F.lower(F.hex(v)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketches."""
    both = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - both
    return F.when(total == 0, F.lit(1.0)).otherwise(both / total).cast("double")


def _stand_in(a: Column, halvings: int) -> Column:
    return (F.size(a) == 1) & (F.get(a, F.lit(0)) >= 1 << (31 - halvings))


def containment(a: Column, b: Column, halvings: int = HALVINGS) -> Column:
    """Estimated share of a's shingles that b has; null where a's sketch is a stand-in and b's is not."""
    share = F.size(F.array_intersect(a, b)) / F.size(a)
    return F.when(F.size(a) == 0, F.lit(1.0)).when(~_stand_in(a, halvings) | _stand_in(b, halvings) | (F.size(b) == 0), share).cast("double")


def merged(a: Column, b: Column, halvings: int = HALVINGS) -> Column:
    """The sketch of two texts' shingles together: a stand-in goes where the other has kept hashes, and of two the least stays."""
    return _below(F.array_union(a, b), 1 << (31 - halvings))


def _position(place: Column, bounds: Column) -> Column:
    """How many of the sorted bounds are at or below place: a binary search."""
    halve = lambda s, _: F.when(
        s["lo"] >= s["hi"], s
    ).otherwise(_step(s, place, bounds))
    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(BUCKETS.bit_length())), start, halve)["lo"]


def _step(s: Column, place: Column, bounds: Column) -> Column:
    middle = ((s["lo"] + s["hi"]) / 2).cast("int")
    low = F.get(bounds, middle) <= place
    return F.struct(F.when(low, middle + 1).otherwise(s["lo"]).alias("lo"), F.when(low, s["hi"]).otherwise(middle).alias("hi"))


def with_next(docs: DataFrame, derive, cols: list[str]) -> DataFrame:
    """doc_id and text of docs and what derive adds to them, each row with the struct `_next` of cols of the row that follows in
    descending doc_id (ties by a hash of the text), the first after the last.

    The order is cut into buckets between rows of a bounded sample; each bucket also gets a copy of the row that begins the
    next one, so a window over single buckets finds every follower. Whole rows are shuffled once, to their buckets."""
    place = F.struct(F.col("doc_id").isNull().cast("int").alias("none"), F.bitwise_not("doc_id").alias("down"), F.xxhash64("text").alias("x"))
    rows = docs.select("doc_id", "text", place.alias("_place"))
    n = rows.count()
    buckets = max(1, min(BUCKETS, n // NEIGHBOURS))
    # a sample by a hash of the row, so that it is the same whenever it is drawn; at most some SAMPLE x BUCKETS rows
    share = min(1.0, SAMPLE * buckets / max(1, n))
    drawn = rows.select("_place").filter(F.pmod(F.xxhash64("_place", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    order = Window.orderBy("_place")
    bounds = drawn.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") % max(1, int(share * n / buckets)) == 0)
    bounds = materialise(bounds.agg(F.sort_array(F.collect_list("_place")).alias("b")), "neighbour-bounds")
    rows = rows.withColumn("_bounds", bounds.scalar()).withColumn("_bucket", _position(F.col("_place"), F.col("_bounds"))).drop("_bounds")
    heads = materialise(rows.groupBy("_bucket").agg(F.min("_place").alias("_head")), "neighbour-heads")  # a row for each bucket
    near = Window.orderBy("_bucket")
    every = near.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("_head", F.col("_bucket").alias("_from"), F.coalesce(F.lag("_bucket").over(near), F.max("_bucket").over(every)).alias("_to"))
    copies = rows.join(F.broadcast(heads), (F.col("_bucket") == F.col("_from")) & (F.col("_place") == F.col("_head")))
    copies = copies.select("doc_id", "text", "_place", F.col("_to").alias("_bucket"), F.lit(1).alias("_copy"))
    both = derive(rows.withColumn("_copy", F.lit(0)).unionByName(copies).repartition("_bucket"))
    follow = Window.partitionBy("_bucket").orderBy("_copy", "_place")
    return both.withColumn("_next", F.lead(F.struct(*cols)).over(follow)).filter("_copy = 0").drop("_copy", "_bucket", "_place")


def fingerprint_documents(df: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last floor(n_chars / 2) code points are replaced by the first as many of the next document."""
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = with_next(docs, lambda d: d.withColumn("sketch", sketch(F.col("text"))), ["text", "sketch"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "sketch", F.col("_next.sketch").alias("next_sketch"), F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.col("_next.text"), F.lit(1), half)).alias("edited"))
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
