"""Reports over truth, candidates and predictions: what blocking can reach, where points are lost, what a list violates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinspark.functions.metrics import measure
from kinspark.functions.text import simple_key

NATIVE = "[ऀ-෿]"


def owners(rec: DataFrame, truth: DataFrame) -> DataFrame:
    """rec (id) with owner, the entity that truth (s1_id, rec_id) names (the least of several); NULL for none."""
    owner = truth.filter("rec_id is not null").groupBy(F.col("rec_id").alias("id")).agg(F.min("s1_id").alias("owner"))
    return rec.join(owner, "id", "left")


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs (s1, rec) with label 1 where truth has them."""
    known = truth.filter("rec_id is not null").select(F.col("s1_id").alias("s1"), F.col("rec_id").alias("rec"), F.lit(1).alias("label")).distinct()
    return pairs.join(known, ["s1", "rec"], "left").fillna({"label": 0})


def true_counts(s1: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1, n_true) of every entity, matches that blocking missed among them."""
    n = truth.filter("rec_id is not null").groupBy(F.col("s1_id").alias("s1")).agg(F.countDistinct("rec_id").alias("n_true"))
    return s1.select(F.col("id").alias("s1")).join(n, "s1", "left").fillna({"n_true": 0})


def f05(tp: Column, n_true: Column, n_pred: Column) -> Column:
    d = 0.25 * n_true + n_pred
    return F.when(d > 0, 1.25 * tp / F.greatest(d, F.lit(1e-12))).otherwise(1.0)


def blocking_report(cand: DataFrame, counts: DataFrame, cap: int = 10) -> DataFrame:
    """One row on candidates (s1, rec, label, kept, cheap_rank) and counts (s1, n_true): pairs, records, pairs a record, recall
    of what is kept and of all, and the best F0.5 that the kept allow, of all entities and of those with matches."""
    sums = cand.agg(F.count_if("kept").alias("pairs"), F.countDistinct("rec").alias("records"), F.sum(F.when(F.col("kept"), F.col("label"))).alias("hits"), F.sum("label").alias("hits_before"), F.sum(F.when(F.col("kept") & (F.col("cheap_rank") <= cap), F.col("label"))).alias("hits_in_cap"))
    found = cand.filter("kept").groupBy("s1").agg(F.sum("label").alias("found"))
    ceiling = counts.join(found, "s1", "left").fillna({"found": 0}).withColumn("f", f05(F.col("found"), F.col("n_true"), F.col("found")))
    best = ceiling.agg(F.sum("n_true").alias("true_pairs"), F.avg("f").alias("ceiling_all"), F.avg(F.when(F.col("n_true") > 0, F.col("f"))).alias("ceiling_matched"))
    share = lambda c: F.coalesce(F.col(c), F.lit(0)) / F.greatest("true_pairs", F.lit(1))
    return sums.crossJoin(best).select("pairs", "records", (F.col("pairs") / F.greatest("records", F.lit(1))).alias("pairs_per_record"), "true_pairs", share("hits").alias("recall"), share("hits_before").alias("recall_before_cap"), share("hits_in_cap").alias("recall_at_cap"), "ceiling_all", "ceiling_matched")


def misses(cand: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1, rec, reason) of true pairs that are not kept: 'capped' where they had been candidates, else 'not_generated'."""
    known = truth.filter("rec_id is not null").select(F.col("s1_id").alias("s1"), F.col("rec_id").alias("rec")).distinct()
    x = known.join(cand.select("s1", "rec", "kept"), ["s1", "rec"], "left").filter("kept is null or not kept")
    return x.select("s1", "rec", F.when(F.col("kept").isNull(), "not_generated").otherwise("capped").alias("reason"))


def gains(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """(s1, n_true, tp, n_pred, n_fp, n_fn, n_miss, f, gain_fp, gain_fn, gain_miss) of every entity: what F0.5 would rise by if
    its wrong pairs, its scored but untaken ones, or its missing ones alone were put right. pairs: s1, rec, label, taken."""
    taken = F.col("taken")
    per = pairs.groupBy("s1").agg(F.sum(F.when(taken, F.col("label")).otherwise(0)).alias("tp"), F.count_if(taken).alias("n_pred"), F.sum(F.when(~taken, F.col("label")).otherwise(0)).alias("n_fn"), F.sum("label").alias("found"))
    x = counts.join(per, "s1", "left").fillna(0, ["tp", "n_pred", "n_fn", "found"])
    x = x.withColumns({"n_fp": F.col("n_pred") - F.col("tp"), "n_miss": F.greatest(F.col("n_true") - F.col("found"), F.lit(0))})
    x = x.withColumn("f", f05(F.col("tp"), F.col("n_true"), F.col("n_pred")))
    with_more = lambda c: f05(F.col("tp") + F.col(c), F.col("n_true"), F.col("n_pred") + F.col(c)) - F.col("f")
    return x.withColumns({"gain_fp": f05(F.col("tp"), F.col("n_true"), F.col("tp")) - F.col("f"), "gain_fn": with_more("n_fn"), "gain_miss": with_more("n_miss")}).drop("found")


def losses(pairs: DataFrame, truth: DataFrame, counts: DataFrame) -> DataFrame:
    """(kind, s1, rec, p, pts) of each wrong ('FP'), untaken ('FN') and missing ('MISS') pair: its share of its entity's gain."""
    g = gains(pairs, counts)
    part = lambda df, kind, gain, n, p: df.join(g, "s1").select(F.lit(kind).alias("kind"), "s1", "rec", p.cast("double").alias("p"), (F.col(gain) / F.greatest(F.col(n), F.lit(1))).alias("pts"))
    known = truth.filter("rec_id is not null").select(F.col("s1_id").alias("s1"), F.col("rec_id").alias("rec")).distinct()
    missing = known.join(pairs.select("s1", "rec"), ["s1", "rec"], "left_anti")
    fp, fn = pairs.filter("taken and label = 0"), pairs.filter("not taken and label = 1")
    return part(fp, "FP", "gain_fp", "n_fp", F.col("p")).unionByName(part(fn, "FN", "gain_fn", "n_fn", F.col("p"))).unionByName(part(missing, "MISS", "gain_miss", "n_miss", F.lit(None)))


def tagged(lost: DataFrame, s1: DataFrame, rec: DataFrame, truth: DataFrame) -> DataFrame:
    """lost with both records' names and addresses and tags: address there or not, script, name shared by entities or not,
    likeness of the names, and for wrong pairs whether the record belongs to another."""
    shared = s1.withColumn("_k", simple_key(F.col("name")))
    shared = shared.join(shared.groupBy("_k").agg(F.count("*").alias("_dup")), "_k")
    a = shared.select(F.col("id").alias("s1"), F.col("name").alias("s1_name"), F.col("address").alias("s1_address"), "_dup")
    b = owners(rec, truth).select(F.col("id").alias("rec"), F.col("name").alias("rec_name"), F.col("address").alias("rec_address"), "owner")
    x = lost.join(a, "s1").join(b, "rec").withColumn("_sim", measure("ratio", simple_key(F.col("s1_name")), simple_key(F.col("rec_name"))))
    tags = F.concat_ws(
        " ", F.when(F.trim(F.coalesce("rec_address", F.lit(""))) == "", "no_addr").otherwise("addr"), F.when(F.rlike("rec_name", F.lit(NATIVE)), "native").otherwise("latin"),
        F.when(F.col("_dup") > 1, "name_shared").otherwise("name_unique"), F.when(F.col("_sim") < 50, "sim<50").when(F.col("_sim") < 85, "sim50-85").otherwise("sim>=85"),
        F.when(F.col("kind") == "FP", F.when(F.col("owner").isNull(), "distractor").otherwise("other_owner")),
    )
    return x.withColumn("tags", tags).select("kind", "s1", "rec", "p", "pts", "s1_name", "s1_address", "rec_name", "rec_address", "tags")


def loss_table(lost: DataFrame, entities: int) -> DataFrame:
    """(kind, tags, pairs, pts): what each kind of error costs, in hundredths of the macro F0.5."""
    return lost.groupBy("kind", "tags").agg(F.count("*").alias("pairs"), (100 * F.sum(F.col("pts").cast("decimal(30,15)")) / entities).cast("double").alias("pts"))


def worst(lost: DataFrame, most: int) -> DataFrame:
    """Of each kind the most errors of the greatest pts, with their place."""
    by = Window.partitionBy("kind").orderBy(F.desc("pts"), "s1", "rec")
    return lost.withColumn("place", F.row_number().over(by).cast("long")).filter(F.col("place") <= most)


def error_buckets(errors: DataFrame, s1: DataFrame, threshold: float, chain: int = 5) -> DataFrame:
    """errors (kind, p, n_true, s1_name, s1_address, rec_name, rec_address) with buckets, one or more for each error."""
    chains = s1.groupBy(F.lower("name").alias("_low")).agg((F.count("*") >= chain).alias("_chain"))
    x = errors.withColumn("_low", F.lower("s1_name")).join(chains, "_low", "left")
    # Words that make a near copy of a name.
    suffix = F.arrays_overlap(F.split(F.lower(F.coalesce("rec_name", F.lit(""))), r"\s+"), F.array(*map(F.lit, "express plus annex outlet ii".split())))
    bare = lambda c: F.length(F.trim(F.coalesce(F.col(c), F.lit("")))) < 5
    found = F.array_compact(F.array(
        F.when(F.abs(F.col("p") - threshold) < 0.25, "boundary"), F.when(F.rlike(F.concat_ws("", "rec_name", "rec_address"), F.lit(r"[^\x{0}-\x{900}]")), "noise:devanagari"),
        F.when(bare("rec_address") | bare("s1_address"), "sparse:no_address"), F.when(F.col("n_true") == 0, "edge:singleton"), F.when(F.col("_chain"), "edge:chain"), F.when(suffix, "edge:near_dup_suffix"),
    ))
    return x.withColumn("buckets", F.when(F.size(found) == 0, F.array(F.lit("other"))).otherwise(found)).drop("_low", "_chain")


def cross_table(errors: DataFrame) -> DataFrame:
    """(bucket, kind, n) of exploded buckets, with the margins as 'All'."""
    x = errors.select(F.explode("buckets").alias("bucket"), "kind").cube("bucket", "kind").agg(F.count("*").alias("n"))
    return x.select(F.coalesce("bucket", F.lit("All")).alias("bucket"), F.coalesce("kind", F.lit("All")).alias("kind"), "n")


def country_summary(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    """(country, entities, mean_matches, empty_rate, mean_candidates, mean_top_p) over all entities. pairs: s1, p, taken."""
    per = pairs.groupBy("s1").agg(F.count_if("taken").alias("n_pred"), F.count("*").alias("n_cand"), F.max("p").alias("top"))
    x = s1.select(F.col("id").alias("s1"), "country").join(per, "s1", "left").fillna({"n_pred": 0, "n_cand": 0, "top": 0.0})
    return x.groupBy("country").agg(F.count("*").alias("entities"), F.avg("n_pred").alias("mean_matches"), F.avg((F.col("n_pred") == 0).cast("double")).alias("empty_rate"), F.avg("n_cand").alias("mean_candidates"), F.avg("top").alias("mean_top_p"))


def profile(records: DataFrame) -> DataFrame:
    """Of records by country and source: rows, shares of empty addresses, of such with a word null, of native and of other than
    ASCII names, and median lengths."""
    share = lambda c: F.avg(c.cast("double"))
    name, address = F.coalesce("name", F.lit("")), F.coalesce("address", F.lit(""))
    return records.groupBy("country", "source").agg(
        F.count("*").alias("rows"), share(F.trim(address) == "").alias("empty_address"), share(F.rlike(address, F.lit(r"(?i)\bnull\b"))).alias("null_in_address"),
        share(F.rlike(name, F.lit(NATIVE))).alias("native_name"), share(F.rlike(name, F.lit(r"[^\x{0}-\x{7f}]"))).alias("other_name"),
        F.percentile(F.length(name), F.lit(0.5)).alias("name_length"), F.percentile(F.length(address), F.lit(0.5)).alias("address_length"),
    )


def truth_statistics(counts: DataFrame, most: int = 10) -> DataFrame:
    """(n_matches clipped at most, entities, share) of counts (n_true), and the overall mean and greatest."""
    whole = Window.partitionBy()
    x = counts.groupBy(F.least("n_true", F.lit(most)).alias("n_matches")).agg(F.count("*").alias("entities"), F.sum("n_true").alias("_s"), F.max("n_true").alias("_m"))
    total = F.sum("entities").over(whole)
    return x.select("n_matches", "entities", (F.col("entities") / total).alias("share"), (F.sum("_s").over(whole) / total).alias("mean"), F.max("_m").over(whole).alias("greatest"))


def truth_violations(truth: DataFrame, s1: DataFrame, rec: DataFrame) -> DataFrame:
    """(owned_twice, owned, cross_country, pairs): records of several entities, and true pairs across countries (ckey)."""
    known = truth.filter("rec_id is not null").distinct()
    twice = known.groupBy("rec_id").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("owned_twice"), F.count("*").alias("owned"))
    across = known.join(s1.select(F.col("id").alias("s1_id"), F.col("ckey").alias("a")), "s1_id").join(rec.select(F.col("id").alias("rec_id"), F.col("ckey").alias("b")), "rec_id")
    return twice.crossJoin(across.agg(F.count_if(F.col("a") != F.col("b")).alias("cross_country"), F.count("*").alias("pairs")))


def upper_bound(s1: DataFrame, rec: DataFrame, truth: DataFrame) -> DataFrame:
    """(records, ambiguous, exact, loss, best): matched records without an address, those whose owner shares its name within
    the country, those that copy it, and the macro F0.5 that is lost if all ambiguous ones are."""
    key = lambda: F.concat(simple_key(F.col("name")), F.lit("|"), F.col("country"))
    named = s1.withColumn("_own", key())
    named = named.join(named.groupBy("_own").agg(F.count("*").alias("_k")), "_own").select(F.col("id").alias("owner"), "_own", "_k")
    bare = owners(rec, truth).filter((F.trim(F.coalesce("address", F.lit(""))) == "") & F.col("owner").isNotNull()).withColumn("_mine", key()).join(named, "owner")
    lost = bare.filter("_k > 1").groupBy(F.col("owner").alias("s1")).agg(F.count("*").alias("lost"))
    counts = true_counts(s1, truth)
    cost = counts.join(lost, "s1", "left").withColumn("tp", F.col("n_true") - F.coalesce("lost", F.lit(0)))
    per = F.when(F.col("lost").isNull(), 0.0).otherwise(1 - F.when(F.col("tp") > 0, 1.25 * F.col("tp") / (0.25 * F.col("n_true") + F.col("tp"))).otherwise(0.0))
    loss = cost.agg(F.avg(per).alias("loss"))
    n = bare.agg(F.count("*").alias("records"), F.count_if(F.col("_k") > 1).alias("ambiguous"), F.count_if(F.col("_mine") == F.col("_own")).alias("exact"))
    return n.crossJoin(loss).withColumn("best", 1 - F.col("loss"))


def importance(rows: DataFrame) -> DataFrame:
    """(feature, gain, gain_pct) of rows (fold, feature, gain): means over folds and their shares."""
    x = rows.groupBy("feature").agg(F.avg("gain").alias("gain"))
    return x.withColumn("gain_pct", 100 * F.col("gain") / F.sum("gain").over(Window.partitionBy()))


#: What a list's identifiers begin with.
ENTITY, RECORD = "S1-", "^S[23]-"


def list_violations(lists: DataFrame, s1: DataFrame, rec: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """(violation, n, example) of lists (source1_entity_id, ids: comma-joined): repeated, missing and unknown entities, ids that
    repeat in a list, of a wrong kind or unknown, and, with candidates (as lists), ids that are none of the entity's."""
    one = lambda df, kind, example: df.agg(F.lit(kind).alias("violation"), F.count("*").alias("n"), F.min(example).alias("example"))
    key = F.col("source1_entity_id")
    entity = s1.select(F.col("id").alias("source1_entity_id"))
    each = lambda df: df.select("source1_entity_id", F.explode(F.filter(F.split("ids", ","), lambda x: x != "")).alias("id"))
    ids = each(lists)
    found = [
        one(lists.groupBy(key).count().filter("count > 1"), "repeated entity", key),
        one(entity.join(lists, "source1_entity_id", "left_anti"), "missing entity", key),
        one(lists.join(entity, "source1_entity_id", "left_anti"), "unknown entity", key),
        one(ids.groupBy(key, "id").count().filter("count > 1"), "repeated id", "id"),
        one(ids.filter(~F.rlike("id", F.lit(RECORD))), "wrong kind of id", "id"),
        one(ids.join(rec.select("id"), "id", "left_anti"), "unknown id", "id"),
    ]
    if candidates is not None:
        found.append(one(ids.join(each(candidates), ["source1_entity_id", "id"], "left_anti"), "no candidate", "id"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out
