"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard has virtual nodes on a ring of 64-bit hashes; a row's key falls in the arc that ends at the next node clockwise.
A full shard sends what overflows clockwise to the next shard that has room. All rows of an arc meet the same shards in
the same order, so the ring's loads are settled from the arcs' counts alone: at most SHARDS x NODES numbers, whatever the
input. An arc's rows are then ranked (cells of an arc are counted first, and ranked apart) and dealt along its segments.

With `slack` 0 the shards' capacities sum to the rows: counts are at most one apart (law "rows"). With slack s each holds
at most ceil((1 + s) x rows / shards), and fewer rows leave their first shard.

Defined cases: a null text has size 1 and CRC 0; a text of any length is read for its size and CRC alone and never shuffled;
null and repeated keys are rows of their own; rows that tie in everything are interchangeable; an empty table gives an empty
result; other columns than key and text are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

SHARDS, NODES, CELLS = 8, 128, 64


def ring(shards: int, nodes: int) -> list[tuple[int, int]]:
    """(place, shard) of the virtual nodes, in order of place; a shard's nodes don't depend on the number of shards."""
    at = {}
    for s in range(shards):
        for v in range(nodes):
            place = int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big", signed=True)
            at.setdefault(place, s)
    return sorted(at.items())


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    if slack:
        return [math.ceil(rows * (1 + Fraction(str(slack))) / shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def settle(nodes: list[tuple[int, int]], counts: list[int], room: list[int]) -> list[list[tuple[int, int, int]]]:
    """For each arc its segments (shard, rows, the shard's slot of the first). In turn each arc offers what is left of it
    to the next shard clockwise that it hasn't asked, until all rows have a place."""
    n, room = len(nodes), list(room)
    filled, left, out = [0] * len(room), list(counts), [[] for _ in nodes]
    asked, pointer = [set() for _ in nodes], list(range(n))
    open_arcs = [a for a in range(n) if left[a]]
    while open_arcs:
        for a in open_arcs:
            while nodes[pointer[a] % n][1] in asked[a]:
                pointer[a] += 1
            s = nodes[pointer[a] % n][1]
            asked[a].add(s)
            k = min(left[a], room[s])
            if k:
                out[a].append((s, k, filled[s]))
                filled[s] += k
                room[s] -= k
                left[a] -= k
        open_arcs = [a for a in open_arcs if left[a]]
    return out


def arc_of(place: int, nodes: list[tuple[int, int]]) -> int:
    return bisect_left([p for p, _ in nodes], place) % len(nodes)


def assign(df: DataFrame, key: str = "doc_id", text_col: str = "text", shards: int = SHARDS, nodes: int = NODES, slack: float = 0.0) -> DataFrame:
    """key, size, text_crc32, shard and slot (gapless from 0 in each shard) of every row."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary"))
    places = ring(shards, nodes)
    rows = df.select(F.col(key).alias(key), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.withColumn("_place", F.xxhash64(F.lit("ring"), key))
    # several places of the ring share a bucket of its leading bits; only within one is the arc looked up
    rows = rows.join(F.broadcast(_buckets(spark, places)), F.shiftright(F.col("_place"), 64 - BITS) == F.col("_bucket"), "inner")
    rows = rows.withColumn("_arc", (F.col("_first") + F.size(F.filter("_places", lambda p: p < F.col("_place")))) % len(places))
    rows = rows.withColumn("_cell", F.pmod(F.xxhash64(key, "text_crc32", "size"), F.lit(CELLS)).cast("int"))
    rows = materialise(rows.select(key, "size", "text_crc32", "_place", "_arc", "_cell"), "ring-rows")

    cells = materialise(rows.groupBy("_arc", "_cell").agg(F.count("*").alias("_n")), "ring-cells")  # at most arcs x CELLS
    arcs = {r["_arc"]: r["n"] for r in cells.groupBy("_arc").agg(F.sum("_n").alias("n")).collect()}  # at most shards x nodes
    counts = [arcs.get(a, 0) for a in range(len(places))]
    segments = settle(places, counts, capacities(sum(counts), shards, slack))
    values = ", ".join(f"({a}, array({', '.join(f'named_struct("s", {s}, "from", {at}L, "n", {k}L, "slot", {slot}L)' for at, (s, k, slot) in zip(_starts(seg), seg))}))" for a, seg in enumerate(segments) if seg)
    if not values:
        values = "(-1, array(named_struct('s', 0, 'from', 0L, 'n', 0L, 'slot', 0L)))"
    segs = spark.sql(f"SELECT * FROM VALUES {values} AS t(_arc, _segments)")
    before = F.sum("_n").over(Window.partitionBy("_arc").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))
    starts = cells.withColumn("_before", F.coalesce(before, F.lit(0))).select("_arc", "_cell", "_before")

    rank = F.row_number().over(Window.partitionBy("_arc", "_cell").orderBy("_place", key, "text_crc32", "size")) - 1
    placed = rows.withColumn("_rank", rank).join(F.broadcast(starts), ["_arc", "_cell"]).join(F.broadcast(segs), "_arc")
    placed = placed.withColumn("_at", F.col("_before") + F.col("_rank"))
    hit = F.filter("_segments", lambda s: (s["from"] <= F.col("_at")) & (F.col("_at") < s["from"] + s["n"]))[0]
    return placed.withColumn("_s", hit).select(key, "size", "text_crc32", F.col("_s.s").cast("int").alias("shard"), (F.col("_s.slot") + F.col("_at") - F.col("_s.from")).cast("long").alias("slot"))


#: Leading bits of a place by which the ring's nodes are looked up.
BITS = 12


def _buckets(spark, places: list[tuple[int, int]]) -> DataFrame:
    """For each value of the leading bits: how many nodes lie below, and the places of those inside. 2^BITS rows."""
    table = {b: [] for b in range(-(1 << (BITS - 1)), 1 << (BITS - 1))}
    for p, _ in places:
        table[p >> (64 - BITS)].append(p)
    out, first = [], 0
    for b in sorted(table):
        inside = ", ".join(f"{p}L" if p > -(2**63) else "-9223372036854775808" for p in table[b])
        out.append(f"({b}L, {first}, {f'array({inside})' if inside else 'CAST(array() AS array<bigint>)'})")
        first += len(table[b])
    return spark.sql(f"SELECT * FROM VALUES {', '.join(out)} AS t(_bucket, _first, _places)")


def _starts(segment: list[tuple[int, int, int]]) -> list[int]:
    out, at = [], 0
    for _, k, _ in segment:
        out.append(at)
        at += k
    return out


def shard_documents(df: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shards with counts at most one apart."""
    out = assign(df, shards=shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
