"""Candidate generation: keys, nearest neighbours and their union. Nothing is gathered: hot keys are pruned by their counts
before any join, and vectors meet in products of blocks of bounded size."""

from __future__ import annotations

import copy
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .vectors import Space

#: Vectors of a block at most, so that a product of two blocks takes 4 MB.
BLOCK = 1024
#: Vectors from which cells are learnt at most.
SAMPLE = 200_000


def record_keys(records: DataFrame) -> DataFrame:
    """(ckey, id, key) of prepared records, as key_lists has them."""
    return key_lists(records).select("ckey", "id", F.explode("keys").alias("key"))


def key_lists(records: DataFrame) -> DataFrame:
    """(ckey, id, keys) of prepared records, as with_keys has them."""
    return with_keys(records, ["ckey", "id"])


def with_keys(records: DataFrame, own: list[str]) -> DataFrame:
    """Own columns and keys of prepared records (the columns below). By kind: `t|` a word, `p|` two of the first four
    words, `c|` the compact name, `hs|` house and street, `pf|` postal code and first word, `mp|`, `mh|` the first word's sound
    with postal code or house, `sf|` street and first word, `ab|` neighbouring words of the address, `ac|` initials or short
    name with one of three numbers, `na|`, `fa|` compact name or first word with a word of the place."""
    none = F.array().cast("array<string>")
    key = lambda kind, *parts: F.concat_ws("|", F.lit(kind), *parts)
    both = lambda kind, a, b: F.when((F.col(a) != "") & (F.col(b) != ""), F.array(key(kind, F.col(a), F.col(b)))).otherwise(none)
    words = F.array_distinct(F.filter("core_toks", lambda t: (F.length(t) >= 2) & ~t.rlike("^[0-9]+$")))
    place = F.slice(F.array_distinct(F.filter("addr_toks", lambda t: (F.length(t) >= 4) & t.rlike(r"^\p{L}+$"))), 1, 10)
    short = F.when(F.length("compact").between(2, 5) & F.rlike("compact", F.lit(r"^\p{L}+$")), F.col("compact")).otherwise("")
    r = records.withColumns({"_w": words, "_place": place, "_acr": F.array_distinct(F.filter(F.array("initials", short), lambda x: x != ""))})
    r = r.withColumn("_head", F.slice("_w", 1, 4)).withColumn("_near", F.slice("addr_toks", 1, 14))
    pairs = F.flatten(F.transform("_head", lambda a, i: F.transform(F.slice("_head", i + 2, F.lit(4)), lambda b: key("p", F.least(a, b), F.greatest(a, b)))))
    steps = F.transform("_near", lambda a, i: F.struct(a.alias("a"), F.get("_near", i + 1).alias("b")))
    steps = F.filter(steps, lambda s: s.b.isNotNull() & (F.length(s.a) + F.length(s.b) >= 5))
    by_acronym = F.flatten(F.transform("_acr", lambda x: F.transform(F.slice("addr_nums", 1, 3), lambda n: key("ac", x, n))))
    named = F.when(F.length("compact") >= 3, F.col("_place")).otherwise(none)
    first = F.get("_w", F.lit(0))
    every = F.concat(
        F.transform("_w", lambda t: key("t", t)), pairs, F.when(F.length("compact") >= 4, F.array(key("c", F.col("compact")))).otherwise(none),
        both("hs", "house", "street"), both("pf", "postal", "first_tok"), both("mp", "meta_first", "postal"), both("mh", "meta_first", "house"), both("sf", "street", "first_tok"),
        F.transform(steps, lambda s: key("ab", s.a, s.b)), by_acronym, F.transform(named, lambda t: key("na", F.col("compact"), t)),
        F.when(first.isNotNull(), F.transform(F.filter(named, lambda t: t != first), lambda t: key("fa", first, t))).otherwise(none),
    )
    return r.select(*own, F.array_distinct(every).alias("keys"))


def pruned_keys(s1_keys: DataFrame, sizes: DataFrame, max_df: int = 100) -> DataFrame:
    """(ckey, key, idf) of the keys that max_df entities at most have: ln((n + 1) / df), n from sizes (ckey, n)."""
    counts = s1_keys.groupBy("ckey", "key").agg(F.count("*").alias("df")).filter(F.col("df") <= max_df)
    return counts.join(F.broadcast(sizes), "ckey").select("ckey", "key", F.log((F.col("n") + 1.0) / F.col("df")).alias("idf"))


def key_overlap(rec_keys: DataFrame, s1_keys: DataFrame, idf: DataFrame, k: int = 15) -> DataFrame:
    """(ckey, rec, s1, score, key_rank): of each record, the k entities of the greatest sums of shared keys' idf."""
    # what entities share too often is gone from their side, so no key of records meets more than that
    weighted = s1_keys.join(idf, ["ckey", "key"]).select("ckey", "key", F.col("id").alias("s1"), "idf")
    scored = rec_keys.select("ckey", "key", F.col("id").alias("rec")).join(weighted, ["ckey", "key"]).groupBy("ckey", "rec", "s1").agg(F.sum("idf").alias("score"))
    w = Window.partitionBy("ckey", "rec").orderBy(F.round("score", 6).desc(), "s1")
    return scored.withColumn("key_rank", F.row_number().over(w)).filter(F.col("key_rank") <= k)


#: Entities' keys that workers get whole at most, and records worked on at a time.
POSTINGS, KEYED = 3_000_000, 2000


class Postings:
    """Entities (ckey, key, s1, idf) by key and country."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.ids = pc.unique(table["s1"])
        self.ids = self.ids.take(pc.sort_indices(self.ids))
        self.keys, self.countries = pc.unique(table["key"]), pc.unique(table["ckey"])
        code = numbered(table["key"], self.keys) * max(1, len(self.countries)) + numbered(table["ckey"], self.countries)
        order = np.argsort(code, kind="stable")
        self.code, self.begin = np.unique(code[order], return_index=True)
        self.begin = np.append(self.begin, len(order))
        self.s1, self.idf = numbered(table["s1"], self.ids)[order].astype(np.int32), table["idf"].to_numpy()[order]

    def best(self, country: pa.Array, keys: pa.Array, row: np.ndarray, rows: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, place among ids, score, rank from 1) of each row's k entities of the greatest sums."""
        key, where = numbered(keys, self.keys), numbered(country, self.countries)[row]
        known = (key >= 0) & (where >= 0)
        code, row = key[known] * max(1, len(self.countries)) + where[known], row[known]
        place = np.minimum(np.searchsorted(self.code, code), max(0, len(self.code) - 1))
        hit = self.code[place] == code if len(self.code) else np.zeros(len(code), bool)
        place, row = place[hit], row[hit]
        out = [], [], [], []
        for lo in range(0, rows, KEYED):
            a, b = np.searchsorted(row, [lo, lo + KEYED])
            n = self.begin[place[a:b] + 1] - self.begin[place[a:b]]
            at = np.arange(n.sum()) + np.repeat(self.begin[place[a:b]] - (np.cumsum(n) - n), n)
            pair, own = np.unique(np.repeat(row[a:b], n) * max(1, len(self.ids)) + self.s1[at], return_inverse=True)
            score = np.bincount(own, self.idf[at], len(pair))
            r, s1 = pair // max(1, len(self.ids)), pair % max(1, len(self.ids))
            order = np.lexsort((s1, -np.round(score, 6), r))
            rank = np.arange(len(r)) - np.searchsorted(r, r) + 1  # rows stay in their places
            order, rank = order[rank <= k], rank[rank <= k]
            for to, x in zip(out, (r[order], s1[order], score[order], rank)):
                to.append(x)
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def postings(s1_keys: DataFrame, idf: DataFrame, most: int) -> Postings | None:
    """Of the entities' keys, None over most."""
    table = s1_keys.join(idf, ["ckey", "key"]).select("ckey", "key", F.col("id").alias("s1"), "idf").limit(most + 1).toArrow()
    return Postings(table) if table.num_rows <= most else None


def key_overlap_by_record(records: DataFrame, s1_keys: DataFrame, idf: DataFrame, k: int = 15, most: int = POSTINGS) -> DataFrame:
    """As key_overlap, of records with their keys (ckey, id, keys): workers have the entities' keys, so no shared key is joined or
    shuffled. Over most keys they are joined."""
    found = postings(s1_keys, idf, most)
    if found is None:
        return key_overlap(records.select("ckey", "id", F.explode("keys").alias("key")), s1_keys, idf, k)
    shared = records.sparkSession.sparkContext.broadcast(found)

    def run(batches):
        for b in batches:
            lists = b.column("keys")
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            row, s1, score, rank = shared.value.best(b.column("ckey"), lists.flatten(), np.repeat(np.arange(len(n)), n), len(n), k)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([b.column("ckey").take(at), b.column("id").take(at), shared.value.ids.take(pa.array(s1)), pa.array(score, pa.float64()), pa.array(rank, pa.int32())], names=["ckey", "rec", "s1", "score", "key_rank"])

    return records.select("ckey", "id", "keys").mapInArrow(run, "ckey string, rec string, s1 string, score double, key_rank int")


def numbered(texts, known) -> np.ndarray:
    """Place of each text among the known ones, -1 for others."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    return pc.fill_null(pc.index_in(texts, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _blocks(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))


def knn_exact(queries: DataFrame, base: DataFrame, k: int = 10) -> DataFrame:
    """(id, neighbour, sim, rnk): of each query (id, v), the k rows of base of the greatest inner products, other than itself;
    ties by neighbour. Blocks of queries and of base meet in pairs; each product keeps k a query, then the best are ranked.
    The work is the product of both sizes: for large bases narrow the search first."""
    qn, bn = (max(1, -(-df.count() // (BLOCK // 2))) for df in (queries, base))
    q = _blocks(queries, qn).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(bn - 1)))).select(F.col("block").alias("i"), F.col("other").alias("j"), "id", "v")
    b = _blocks(base, bn).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(qn - 1)))).select(F.col("other").alias("i"), F.col("block").alias("j"), "id", "v")

    met = q.groupBy("i", "j").cogroup(b.groupBy("i", "j")).applyInPandas(lambda key, left, right: _product(left, right, k), "id long, neighbour long, sim double")
    return _best(met, k)


def _product(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of a block of base for each query of a block."""
    if not len(left) or not len(right):
        return pd.DataFrame({"id": [], "neighbour": [], "sim": []})
    right = right.sort_values("id")
    sims = np.stack(left.v.to_numpy()).astype(np.float64) @ np.stack(right.v.to_numpy()).astype(np.float64).T
    ids, names = left.id.to_numpy(), right.id.to_numpy()
    sims[ids[:, None] == names] = -np.inf
    best = np.argsort(-sims, axis=1, kind="stable")[:, :k]
    out = pd.DataFrame({"id": np.repeat(ids, best.shape[1]), "neighbour": names[best].ravel(), "sim": np.take_along_axis(sims, best, 1).ravel()})
    return out[np.isfinite(out.sim)]


def _best(met: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("id").orderBy(F.desc("sim"), "neighbour")
    return met.withColumn("rnk", F.row_number().over(w)).filter(F.col("rnk") <= k)


def cells(base: DataFrame, lists: int, sample: int = 40, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Centres (unit length) of lists cells, by k-means on a bounded sample of sample x lists vectors, chosen by a hash."""
    drawn = base.select("v").orderBy(F.xxhash64(F.lit(seed), "id")).limit(min(sample * lists, SAMPLE)).collect()
    return _centres(np.array([r.v for r in drawn], np.float64), lists, rounds, seed)


def _centres(x: np.ndarray, lists: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    centres = x[np.random.default_rng(seed).permutation(len(x))[:lists]]
    for _ in range(rounds):
        own = np.concatenate([np.argmax(x[i : i + SEARCHED] @ centres.T, axis=1) for i in range(0, len(x), SEARCHED)])
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        alive = np.bincount(own, minlength=len(centres)) > 0
        centres = total[alive] / np.maximum(np.linalg.norm(total[alive], axis=1, keepdims=True), 1e-12)
    return centres


def knn_cells(queries: DataFrame, base: DataFrame, k: int = 10, probes: int = 24, lists: int | None = None) -> DataFrame:
    """As knn_exact, searched in each query's nearest cells alone: every row of base lies in the cell of its nearest centre.
    Cells of many rows are cut into blocks of bounded size, so a query meets blocks, never a whole hot cell at once."""
    base = base.select("id", "v").toDF("id", "v")  # columns of their own: queries and base may be one table
    n = base.count()
    lists = lists or _lists(n)
    if n == 0:
        return knn_exact(queries, base, k)
    shared = base.sparkSession.sparkContext.broadcast(cells(base, min(lists, n)))

    def nearest(many: int):
        def of(v: pd.Series) -> pd.Series:
            if not len(v):
                return pd.Series([], dtype=object)
            sims = np.stack(v.to_numpy()).astype(np.float64) @ shared.value.T
            return pd.Series(list(np.argsort(-sims, axis=1, kind="stable")[:, :many].astype(np.int32)))

        return F.pandas_udf(of, "array<int>")

    b = base.withColumn("cell", F.get(nearest(1)("v"), F.lit(0)))
    blocks = b.groupBy("cell").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.lit(1)).cast("int").alias("blocks"))
    b = b.join(F.broadcast(blocks), "cell").select(F.col("cell").alias("i"), F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("j"), "id", "v")
    q = queries.withColumn("cell", F.explode(nearest(probes)("v"))).join(F.broadcast(blocks), "cell")
    # queries of one cell are cut into blocks too: (j, part) of them
    parts = q.groupBy("cell").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.lit(1)).cast("int").alias("parts"))
    q = q.join(F.broadcast(parts), "cell").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    q = q.select(F.col("cell").alias("i"), "j", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"), "id", "v")
    b = b.join(F.broadcast(parts.withColumnRenamed("cell", "i")), "i").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    met = q.groupBy("i", "j", "part").cogroup(b.groupBy("i", "j", "part")).applyInPandas(lambda key, left, right: _product(left, right, k), "id long, neighbour long, sim double")
    return _best(met, k)


def _lists(n: int) -> int:
    """Cells of n rows."""
    return int(min(65536, max(16, min(4 * n**0.5, n / 50))))


#: Distinct texts of entities that workers get whole at most, entities of several countries together at most, and queries searched
#: at a time.
TEXTS, TOGETHER, SEARCHED = 400_000, 200_000, 2000


def together(sizes: dict[str, int], most: int) -> list[list[str]]:
    """Countries in groups of most entities at most, a larger one by itself: candidates never cross a country's border."""
    groups, n = [], most + 1
    for country in sorted(sizes):
        if n + sizes[country] > most:
            groups.append([])
            n = 0
        groups[-1].append(country)
        n += sizes[country]
    return groups


class TextIndex:
    """The distinct texts of a Space by country and cell, for searches of their coordinates: as knn_cells, each text in the cell
    of its nearest centre, a query in its nearest cells alone, but nothing is shuffled. All cells are searched where a country
    has as many as probes or fewer."""

    def __init__(self, space: Space, ids: list[list[str]], probes: int = 24, sample: int = 40, seed: int = 7):
        self.space, self.probes = space, probes
        self.size = np.array([len(x) for x in ids], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.size)])
        self.names = pa.array([i for x in ids for i in x], pa.string())
        self.by: dict[str, tuple] = {}
        country = np.array([c for c, _ in space.place], object)
        for c in set(country.tolist()):
            at = np.flatnonzero(country == c)
            lists = min(_lists(len(at)), len(at))
            drawn = np.random.default_rng(seed).permutation(len(at))[: min(sample * lists, SAMPLE)]
            centres = _centres(space.v[at[drawn]].astype(np.float64), lists).astype(np.float32)
            own = np.concatenate([np.argmax(space.v[at[i : i + SEARCHED]] @ centres.T, axis=1) for i in range(0, len(at), SEARCHED)])
            order = np.argsort(own, kind="stable")
            self.by[c] = centres, at[order], np.searchsorted(own[order], np.arange(len(centres) + 1))

    def dots(self, left: tuple[list, list], right: tuple[list, list]) -> np.ndarray:
        return self.space.dots(left, right)

    def without_places(self) -> TextIndex:
        """One that searches but has no dots(): its texts stay behind."""
        out = copy.copy(self)
        out.space = replace(self.space, place={})
        return out

    def search(self, country: str, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each query the k nearest texts (or fewer: -1) and their likeness to five places, ties in the order of the texts."""
        best, found = np.full((len(v), k), -np.inf), np.full((len(v), k), -1, np.int64)
        if country not in self.by or not len(v):
            return found, best
        centres, at, ends = self.by[country]
        sims = v @ centres.T
        probes = min(self.probes, len(centres))
        cell = np.argpartition(-sims, probes - 1, axis=1)[:, :probes].ravel()
        by_cell = np.argsort(cell, kind="stable")
        query, cell = (by_cell // probes), cell[by_cell]
        edge = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))
        for lo, hi in zip(edge[:-1], edge[1:]):
            q = query[lo:hi]
            for i in range(ends[cell[lo]], ends[cell[lo] + 1], BLOCK):  # a large cell in parts
                texts = at[i : min(i + BLOCK, ends[cell[lo] + 1])]
                # 1e-12 a place of a text, so that ties are broken alike in any order of search
                near = np.round((v[q] @ self.space.v[texts].T).astype(np.float64), 5) - texts * 1e-12
                near, names = np.concatenate([best[q], near], axis=1), np.concatenate([found[q], np.broadcast_to(texts, near.shape)], axis=1)
                top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                best[q], found[q] = np.take_along_axis(near, top, 1), np.take_along_axis(names, top, 1)
        order = np.argsort(-best, axis=1, kind="stable")
        return np.take_along_axis(found, order, 1), np.take_along_axis(best, order, 1)

    def nearest(self, country: list[str], text: list[str], k: int, v: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, place among names, rank from 1) of the k entities nearest to each query, those of a text by id. v: the
        queries' coordinates, where they are known."""
        out = [], [], []
        where = np.array(country, object)
        v = self.space.grams.dense(country, text, self.space.axes) if v is None else v
        some = np.linalg.norm(v, axis=1) > 0
        for c in self.by:
            mine = np.flatnonzero((where == c) & some)
            for i in range(0, len(mine), SEARCHED):
                q = mine[i : i + SEARCHED]
                texts, _ = self.search(c, v[q].astype(np.float32), k)
                row, place = np.nonzero(texts >= 0)
                texts = texts[row, place]
                n = self.size[texts]
                # entities before those of a text, of the same query
                done = np.cumsum(n) - n
                done -= done[np.searchsorted(row, row)]
                n = np.clip(k - done, 0, n)
                of = np.repeat(np.arange(len(n)), n)
                step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                for to, x in zip(out, (q[row[of]], self.begin[texts[of]] + step, done[of] + step + 1)):
                    to.append(x)
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def knn_texts(records: DataFrame, col: str, index, k: int) -> DataFrame:
    """(rec, s1, rnk): of each record (ckey, id, col) the k entities whose texts are nearest in a broadcast TextIndex; none for a text
    without grams. Equal texts of a batch are searched once."""

    def run(batches):
        for b in batches:
            every: dict[tuple, int] = {}
            own = np.array([every.setdefault(x, len(every)) for x in zip(b.column("ckey").to_pylist(), b.column("t").to_pylist())], np.int64)
            if not len(own):
                continue
            query, name, rank = index.value.nearest(*map(list, zip(*every)), k)
            begin = np.searchsorted(query[order := np.argsort(query, kind="stable")], np.arange(len(every) + 1))
            for i in range(0, len(own), SEARCHED):
                mine = own[i : i + SEARCHED]
                n = begin[mine + 1] - begin[mine]
                of = np.repeat(np.arange(len(mine)), n)
                at = order[np.arange(len(of)) + np.repeat(begin[mine] - (np.cumsum(n) - n), n)]
                yield pa.RecordBatch.from_arrays([b.column("rec").take(pa.array(i + of)), index.value.names.take(pa.array(name[at])), pa.array(rank[at], pa.int32())], names=["rec", "s1", "rnk"])

    return records.select("ckey", F.col("id").alias("rec"), F.coalesce(F.col(col), F.lit("")).alias("t")).mapInArrow(run, "rec string, s1 string, rnk int")


def candidate_union(parts: dict[str, DataFrame], missing: dict[str, int]) -> DataFrame:
    """(rec, s1, <part>_rank..., n_blockers) of all pairs that any part (rec, s1, rnk) names; absent ranks as given."""
    rows = None
    for name, df in parts.items():
        part = df.select("rec", "s1", F.lit(name).alias("part"), "rnk")
        rows = part if rows is None else rows.unionByName(part)
    ranks = [F.min(F.when(F.col("part") == p, F.col("rnk"))).alias(f"{p}_rank") for p in parts]
    u = rows.groupBy("rec", "s1").agg(*ranks)
    n = sum((F.col(f"{p}_rank").isNotNull().cast("int") for p in parts), F.lit(0))
    return u.withColumn("n_blockers", n).fillna({f"{p}_rank": missing[p] for p in parts})


def cheap_score(cand: DataFrame) -> DataFrame:
    """cand with cheap: cosines of name, of name and address and of address, shared keys and the number of blockers, weighed."""
    score = 0.3 * F.col("cos_name_d") + 0.3 * F.col("cos_full_d") + 0.25 * F.col("cos_addr_c") + 0.15 * F.tanh(F.col("key_score") / 10.0) + 0.01 * F.col("n_blockers")
    return cand.withColumn("cheap", score)


#: What capped() keeps unless told otherwise.
CAPS = {"cap": 10, "cap_bare": 25, "by_address": 3, "least_cosine": 0.5, "by_key": 2}


def capped(cand: DataFrame, cap: int = CAPS["cap"], cap_bare: int = CAPS["cap_bare"], by_address: int = CAPS["by_address"], least_cosine: float = CAPS["least_cosine"], by_key: int = CAPS["by_key"]) -> DataFrame:
    """cand (rec, s1, cheap, cos_addr_c, key_rank, no_addr) with cheap_rank and kept: the first cap by the cheap score (more of a
    record without an address), the nearest addresses and the best by keys. All rows stay, so that a miss can be told from a cut."""
    of = lambda c: Window.partitionBy("rec").orderBy(F.desc(c), "s1")
    ranked = cand.withColumns({"cheap_rank": F.row_number().over(of("cheap")), "_addr_rank": F.row_number().over(of("cos_addr_c"))})
    near = (F.col("_addr_rank") <= by_address) & (F.col("cos_addr_c") >= least_cosine)
    kept = (F.col("cheap_rank") <= F.when(F.col("no_addr"), cap_bare).otherwise(cap)) | near | (F.col("key_rank") <= by_key)
    return ranked.withColumn("kept", kept).drop("_addr_rank")


def orphans(records: DataFrame, s1: DataFrame) -> DataFrame:
    """(ckey, records): keys of records that no entity has, which can have no candidates."""
    return records.join(s1.select("ckey").distinct(), "ckey", "left_anti").groupBy("ckey").agg(F.count("*").alias("records"))
