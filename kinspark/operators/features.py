"""Features of candidate pairs (rec, s1): column expressions over both records' prepared columns, but for the string measures.
What depends on one record is worked out once for each record; unknown is NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kinspark.functions.fixed import PAIR_SIGN
from kinspark.functions.metrics import measure
from kinspark.functions.text import leading_int, missing_eq

from . import pair_arrays

PROVENANCE = ["b_knn_name", "b_knn_full", "b_key", "b_knn_addr", "n_blockers", "knn_name_rank", "knn_full_rank", "key_rank", "knn_addr_rank", "cheap", "cheap_rank", "cos_name_d", "cos_full_d", "key_score"]
COSINES = ["cos_name_c", "cos_full_c", "cos_addr_c"]
EQUAL = ["first_tok", "meta_first", "sdx_first", "house", "postal", "unit", "street", "legal", "street_type"]
ATOMS = ["house", "postal", "street", "street_type", "unit"]
CONTEXT = ["combo", "cos_name_c", "cos_full_c", "name_tset", "key_score", "cheap", "name_full_ratio"]
TEXTS = ["name_n", "core", "addr_n", "full", "compact", "phon", "initials", *EQUAL]


def token_idf(s1: DataFrame, col: str, sizes: DataFrame) -> DataFrame:
    """(ckey, tok, idf): ln((n + 1) / (df + 1)) + 1 over the entities that have the word."""
    df = s1.select("ckey", F.explode(F.array_distinct(col)).alias("tok")).groupBy("ckey", "tok").agg(F.count("*").alias("df"))
    return df.join(F.broadcast(sizes), "ckey").select("ckey", "tok", (F.log((F.col("n") + 1.0) / (F.col("df") + 1.0)) + 1).alias("idf"))


def with_weights(records: DataFrame, s1: DataFrame, sizes: DataFrame) -> DataFrame:
    """records with name_w, addr_w and full_w: maps of each distinct word to its idf among the entities; in full_w that of
    names holds where a word has both, and a word without any weighs ln(n + 1) + 1."""
    name, addr = (token_idf(s1, c, sizes).withColumnRenamed("idf", i) for c, i in (("core_toks", "ni"), ("addr_toks", "ai")))
    words = records.select("ckey", "id", "core_toks", "addr_toks", F.explode(F.array_distinct(F.concat("core_toks", "addr_toks"))).alias("tok"))
    words = words.join(name, ["ckey", "tok"], "left").join(addr, ["ckey", "tok"], "left").join(F.broadcast(sizes), "ckey", "left").withColumn("d", F.log(F.coalesce("n", F.lit(0)) + 1.0) + 1)
    has = lambda c: F.array_contains(F.col(c), F.col("tok"))
    pack = lambda when, w, to: F.map_from_entries(F.collect_list(F.when(when, F.struct("tok", w.alias("w"))))).alias(to)
    maps = words.groupBy("ckey", "id").agg(pack(has("core_toks"), F.coalesce("ni", "d"), "name_w"), pack(has("addr_toks"), F.coalesce("ai", "d"), "addr_w"), pack(F.lit(True), F.coalesce("ni", "ai", "d"), "full_w"))
    empty = F.create_map().cast("map<string,double>")
    out = records.join(maps, ["ckey", "id"], "left")
    return out.withColumns({c: F.coalesce(c, empty) for c in ("name_w", "addr_w", "full_w")})


def with_frequencies(records: DataFrame, s1: DataFrame) -> DataFrame:
    """records with name_freq and first_freq: ln(1 + how many entities of the country have that core name, that first word)."""
    for col, to in (("core", "name_freq"), ("first_tok", "first_freq")):
        counts = s1.groupBy("ckey", col).agg(F.count("*").alias("_n"))
        records = records.join(counts, ["ckey", col], "left").withColumn(to, F.log1p(F.coalesce("_n", F.lit(0)).cast("double"))).drop("_n")
    return records


def overlap(prefix: str, a: Column, b: Column) -> dict[str, Column]:
    """Of two maps of words to weights: words in common and on one side alone, and their weights."""
    ka, kb = F.map_keys(a), F.map_keys(b)
    both = F.array_intersect(ka, kb)
    n = F.size(both).cast("double")
    none = (F.size(ka) == 0) & (F.size(kb) == 0)
    total = lambda words, m: F.aggregate(words, F.lit(0.0), lambda acc, t: acc + F.try_element_at(m, t))
    common, wa, wb = total(both, a), total(ka, a), total(kb, b)
    union = wa + wb - common
    found = {
        "common": n,
        "only1": F.when(~none, F.size(ka) - n),
        "only2": F.when(~none, F.size(kb) - n),
        "wjac": F.when(union > 0, common / union),
        "wcont1": F.when(wa > 0, common / wa),
        "wcont2": F.when(wb > 0, common / wb),
        "winter": common,
        "wonly1": wa - common,
        "wonly2": wb - common,
        "wmaxonly": F.greatest(wa, wb) - common,
    }
    return {f"{prefix}_{k}": v for k, v in found.items()}


def number_overlap(prefix: str, a: Column, b: Column) -> dict[str, Column]:
    """Distinct numbers in common and on one side alone."""
    n = F.size(F.array_intersect(a, b)).cast("double")
    na, nb = F.size(F.array_distinct(a)), F.size(F.array_distinct(b))
    none = (na == 0) & (nb == 0)
    return {f"{prefix}_common": n, f"{prefix}_only1": F.when(~none, na - n), f"{prefix}_only2": F.when(~none, nb - n)}


def joined(cand: DataFrame, s1: DataFrame, rec: DataFrame, by_entity: bool = False) -> DataFrame:
    """cand with both records' columns as structs a (of s1) and b (of rec). Pairs of a record come together, or those of an entity,
    whose records are much alike, so that a batch measures fewer texts."""
    side = lambda t, key, to: t.select(F.col("id").alias(key), F.struct(*[c for c in t.columns if c != "id"]).alias(to))
    sides = [(side(s1, "s1", "a"), "s1"), (side(rec, "rec", "b"), "rec")]
    for t, key in reversed(sides) if by_entity else sides:
        cand = cand.join(t, key)
    return cand


def flags() -> dict[str, Column]:
    """Equality of parts, address atoms, acronym, lengths and frequencies."""
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    f = {"core_eq": (a("core") == b("core")).cast("double"), "compact_eq": (a("compact") == b("compact")).cast("double")}
    f |= {f"{c}_eq": missing_eq(a(c), b(c)).cast("double") for c in EQUAL}
    f["house_absdiff"] = F.log1p(F.abs(leading_int(a("house")) - leading_int(b("house"))).cast("double"))
    known = (a("postal") != "") & (b("postal") != "")
    f["postal_prefix_eq"] = F.when(known, (F.substring(a("postal"), 1, 3) == F.substring(b("postal"), 1, 3)).cast("double"))
    f["postal_lev"] = F.when(known, F.levenshtein(a("postal"), b("postal")).cast("double"))
    atoms = [f[f"{c}_eq"] for c in ATOMS]
    sum_of = lambda cols: sum(cols[1:], cols[0])
    f["addr_atoms_both"] = sum_of([x.isNotNull().cast("double") for x in atoms])
    f["addr_atoms_agree"] = sum_of([F.coalesce(x, F.lit(0.0)) for x in atoms])
    f["addr_atoms_conflict"] = f["addr_atoms_both"] - f["addr_atoms_agree"]
    is_short = lambda x, y: (x("initials") != "") & (x("initials") == y("compact"))
    f["acronym"] = (is_short(a, b) | is_short(b, a)).cast("double")
    long1, long2 = F.length(a("core")).cast("double"), F.length(b("core")).cast("double")
    f |= {"name_len1": long1, "name_len2": long2, "name_len_ratio": F.least(long1, long2) / F.greatest(long1, long2, F.lit(1.0))}
    f |= {f"name_ntok{i}": F.size(x("core_toks")).cast("double") for i, x in ((1, a), (2, b))} | {f"addr_len{i}": F.length(x("addr_n")).cast("double") for i, x in ((1, a), (2, b))}
    return f | {"s1_name_freq": a("name_freq"), "rec_name_freq": b("name_freq"), "s1_first_freq": a("first_freq")}


def likenesses() -> dict[str, Column]:
    """String measures of names, addresses and their forms."""
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    of = lambda m, c: measure(m, a(c), b(c))
    named, placed = (a("core") != "") & (b("core") != ""), (a("addr_n") != "") & (b("addr_n") != "")
    kinds = {"ratio": "ratio", "pratio": "partial_ratio", "tsort": "token_sort_ratio", "tset": "token_set_ratio", "jw": "jaro_winkler"}
    f = {f"name_{k}": F.when(named, of(m, "core")) for k, m in kinds.items()}
    f["name_full_ratio"] = of("ratio", "name_n")
    f |= {f"addr_{k}": F.when(placed, of(kinds[k], "addr_n")) for k in ("ratio", "pratio", "tset", "tsort")}
    f |= {"full_tset": of("token_set_ratio", "full"), "phon_ratio": of("ratio", "phon"), "compact_jw": of("jaro_winkler", "compact"), "first_jw": of("jaro_winkler", "first_tok")}
    shared = of("lcs", "compact").cast("double")
    long1, long2 = F.length(a("compact")), F.length(b("compact"))
    f |= {"compact_extra1": long1 - shared, "compact_extra2": long2 - shared, "compact_extra_max": F.greatest(long1, long2) - shared}
    f["name2_in_addr1"] = F.when(named & (a("addr_n") != ""), measure("partial_ratio", b("core"), a("addr_n")))
    return f


def overlaps() -> dict[str, Column]:
    f: dict[str, Column] = {}
    for prefix, c in (("tok_name", "name_w"), ("tok_addr", "addr_w"), ("tok_full", "full_w")):
        f |= overlap(prefix, F.col(f"a.{c}"), F.col(f"b.{c}"))
    for prefix, c in (("num_addr", "addr_nums"), ("num_name", "name_nums")):
        f |= number_overlap(prefix, F.col(f"a.{c}"), F.col(f"b.{c}"))
    return f


def rank_and_gap(df: DataFrame, group: str, other: str, columns: list[str], suffix: str) -> DataFrame:
    """df with <column>_rank_<suffix> and <column>_gap_<suffix>: the place of a value (unknown: 0) in its group, ties by other,
    and its distance to the best other one, NULL where it is alone."""
    made = {}
    for c in columns:
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        w = Window.partitionBy(group).orderBy(x.desc(), other)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rank = F.row_number().over(w)
        made[f"{c}_rank_{suffix}"] = rank.cast("double")
        made[f"{c}_gap_{suffix}"] = x - F.when(rank == 1, F.nth_value(x, 2).over(whole)).otherwise(F.first(x).over(whole))
    return df.withColumns(made)


def with_context(df: DataFrame) -> DataFrame:
    """df (rec, s1, and the features it needs) with n_cand_rec, combo and places among the record's candidates."""
    known = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    combo = 0.4 * known("cos_full_c") + 0.3 * known("tok_full_wjac") + 0.3 * known("name_tset") / 100
    df = df.withColumns({"n_cand_rec": F.count("*").over(Window.partitionBy("rec")).cast("double"), "combo": combo})
    return rank_and_gap(df, "rec", "s1", CONTEXT, "rec")


def compute(cand: DataFrame, s1: DataFrame, rec: DataFrame) -> DataFrame:
    """rec, s1 and the 118 features of every candidate pair. cand has PROVENANCE and COSINES, s1 and rec the prepared columns,
    with weights and frequencies, rec also source; all candidates of a record must be there, for its context."""
    met = joined(cand, s1, rec)
    met = met.select("rec", "s1", *PROVENANCE, *COSINES, F.col("b.source").cast("double").alias("rec_source"), F.col("a.translit").cast("double").alias("translit1"), F.col("b.translit").cast("double").alias("translit2"), *[c.alias(k) for k, c in (overlaps() | flags() | likenesses()).items()])
    return with_context(met)


#: Entities that workers get whole at most.
ENTITIES = 400_000
#: Columns that workers need of records.
RECORD = ["source", "translit", "core_toks", "addr_toks", "name_nums", "addr_nums", *TEXTS]


def _ready(x: DataFrame, s1: DataFrame, sizes: DataFrame) -> DataFrame:
    return with_frequencies(with_weights(x, s1, sizes), s1)


def _entities(weighted: DataFrame, sizes: DataFrame, most: int) -> pair_arrays.Entities | None:
    """None over most."""
    found = weighted.select("id", "ckey", "translit", "core_toks", "name_nums", "addr_nums", "name_w", "addr_w", "full_w", "name_freq", "first_freq", *TEXTS).limit(most + 1).toArrow()
    return pair_arrays.Entities(found, {r.ckey: r.n for r in sizes.collect()}, TEXTS) if found.num_rows <= most else None


def kept(cand: DataFrame, s1: DataFrame, rec: DataFrame, sizes: DataFrame) -> tuple[StructType, pair_arrays.Kept] | None:
    """Schema of the features of candidates like cand, and what makes them in workers from the candidates of a batch of records;
    None over ENTITIES."""
    weighted = _ready(s1, s1, sizes)
    entities = _entities(weighted, sizes, ENTITIES)
    return entities and (compute(cand, weighted, _ready(rec, s1, sizes)).schema, pair_arrays.Kept(entities, [*PROVENANCE, *COSINES], EQUAL, ATOMS, CONTEXT))


def compute_by_record(cand: DataFrame, s1: DataFrame, rec: DataFrame, sizes: DataFrame, most: int = ENTITIES) -> DataFrame:
    """As compute, of prepared records without weights: records meet their candidates, workers have the entities, and nothing else
    is joined or sorted. Over most entities both sides are joined, as compute does it."""
    weighted = _ready(s1, s1, sizes)
    joined_ = compute(cand, weighted, _ready(rec, s1, sizes))
    entities = _entities(weighted, sizes, most)
    if entities is None:
        return joined_
    shared = s1.sparkSession.sparkContext.broadcast(entities)
    schema, given = joined_.schema, [*PROVENANCE, *COSINES]
    # records of one entity, whose texts are much alike, come together: by the first candidate, a bounded number of rows in each part
    met = cand.groupBy("rec").agg(F.collect_list(F.struct("s1", *given)).alias("met"), F.min_by("s1", "cheap_rank").alias("_first"))
    own = rec.select(F.col("id").alias("rec"), "ckey", *RECORD)
    parts = max(4 * s1.sparkSession.sparkContext.defaultParallelism, int(s1.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = own.join(met, "rec").repartitionByRange(parts, "_first", "rec").sortWithinPartitions("_first", "rec").drop("_first")

    def run(batches):
        to = to_arrow_schema(schema)
        for batch in batches:
            yield from pair_arrays.features(batch, shared.value, to, given, EQUAL, ATOMS, CONTEXT)

    return rows.mapInArrow(run, schema)


def group_stats(pairs: DataFrame, group: str, other: str, prefix: str) -> DataFrame:
    """pairs (p) with, for each pair in its group: rank, the best other p, the gap to it (p where alone), p by the group's
    greatest, what the others sum to, the group's size, and others above 0.5 and 0.9. Sums are of exact decimals, so no order
    of rows can change them."""
    w = Window.partitionBy(group)
    by = w.orderBy(F.desc("p"), other)
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    p = F.col("p")
    rank, top = F.row_number().over(by), F.first("p").over(whole)
    best = F.when(rank == 1, F.nth_value("p", 2).over(whole)).otherwise(top)
    exact = p.cast("decimal(20,12)")
    above = lambda t: F.sum((p > t).cast("long")).over(w) - (p > t).cast("long")
    made = {"rank": rank.cast("long"), "other": best, "gap": p - F.coalesce(best, F.lit(0.0)), "ratio": p / F.greatest(top, F.lit(1e-6)), "sum_other": (F.sum(exact).over(w) - exact).cast("double"), "n": F.count("*").over(w), "c5_other": above(0.5), "c9_other": above(0.9)}
    return pairs.withColumns({f"{prefix}_{k}": c for k, c in made.items()})


#: Features of the first stage that the second one keeps.
RAW = ["cheap", "cos_full_c", "cos_name_c", "cos_addr_c", "name_tset", "addr_len2", "s1_name_freq", "combo", "house_eq", "tok_name_wjac", "rec_source", "n_cand_rec"]


def stage_two(pairs: DataFrame, raw: list[str] = RAW, judged: DataFrame | None = None) -> DataFrame:
    """(rec, s1, p1, p1_logit, what competes with the pair on both sides, raw). judged (rec, s1, and columns): scores of a second
    judge of some pairs, NULL for the others."""
    p = F.least(F.greatest(F.col("p"), F.lit(1e-6)), F.lit(1 - 1e-6))
    df = group_stats(group_stats(pairs, "rec", "s1", "rec"), "s1", "rec", "ent")
    sides = [c for c in df.columns if c.startswith(("rec_", "ent_")) and c not in raw]
    df = df.select("rec", "s1", F.col("p").alias("p1"), F.log(p / (1 - p)).alias("p1_logit"), *sides, *raw)
    return df if judged is None else df.join(judged, ["rec", "s1"], "left")


def judge_features(scored: DataFrame) -> DataFrame:
    """(rec, s1, ce_logit, places and gaps on both sides, ce_x_p1) of pairs (rec, s1, logit, p) that a second judge has scored."""
    x = scored.withColumn("pc", 1 / (1 + F.exp(-F.least(F.greatest(F.col("logit"), F.lit(-30.0)), F.lit(30.0)))))
    for side, group, other in (("rec", "rec", "s1"), ("ent", "s1", "rec")):
        by = Window.partitionBy(group).orderBy(F.desc("pc"), other)
        whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rank = F.row_number().over(by)
        best = F.when(rank == 1, F.nth_value("pc", 2).over(whole)).otherwise(F.first("pc").over(whole))
        x = x.withColumns({f"ce_{side}_rank": rank.cast("long"), f"ce_{side}_gap": F.col("pc") - F.coalesce(best, F.lit(0.0))})
    return x.select("rec", "s1", F.col("logit").alias("ce_logit"), "ce_rec_rank", "ce_rec_gap", "ce_ent_rank", "ce_ent_gap", F.sqrt(F.col("pc") * F.least(F.greatest(F.col("p"), F.lit(0.0)), F.lit(1.0))).alias("ce_x_p1"))


def pair_codes(pairs: DataFrame, s1: DataFrame, rec: DataFrame) -> DataFrame:
    """pairs (s1, rec) with codes: what a judge reads of them, the sign of a pair and both sides' name_ids and addr_ids."""
    a = s1.select(F.col("id").alias("s1"), F.concat("name_ids", "addr_ids").alias("_a"))
    b = rec.select(F.col("id").alias("rec"), F.concat("name_ids", "addr_ids").alias("_b"))
    return pairs.join(a, "s1").join(b, "rec").withColumn("codes", F.concat(F.array(F.lit(PAIR_SIGN)), "_a", "_b")).drop("_a", "_b")
