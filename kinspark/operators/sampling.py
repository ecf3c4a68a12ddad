"""Samples and folds by hashes of ids, the same whenever they are drawn. Exact sizes need places among a stratum's rows; they
are counted in cells of the hash first, so no task ranks a whole stratum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of the hash; those of a stratum are ranked apart.
CELLS = 1024


def hashed(key: Column, seed: str) -> Column:
    """The first 60 bits of an MD5 digest."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 15), 16, 10).cast("long")


def unit(key: Column, seed: str) -> Column:
    """A number from 0 to 1 out of the first 32 bits of an MD5 digest."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8), 16, 10).cast("long") / F.lit(0xFFFFFFFF)


def ranked(df: DataFrame, key: str, stratum: list[str], seed: str) -> DataFrame:
    """df with k, the place (from 1) of each row in its stratum by the hash, and n, the stratum's size."""
    h = hashed(F.col(key), seed)
    cell = F.floor(h / ((1 << 60) // CELLS)).cast("int")
    x = df.withColumns({"_h": h, "_c": cell})
    sizes = x.groupBy(*stratum, "_c").agg(F.count("*").alias("_m"))
    by = Window.partitionBy(*stratum)
    sizes = sizes.withColumns({"_b": F.sum("_m").over(by.orderBy("_c")) - F.col("_m"), "n": F.sum("_m").over(by)}).drop("_m")
    place = F.row_number().over(Window.partitionBy(*stratum, "_c").orderBy("_h", key))
    return x.withColumn("_r", place).join(F.broadcast(sizes), [*stratum, "_c"]).withColumn("k", F.col("_r") + F.col("_b")).drop("_h", "_c", "_r", "_b")


def sample_entities(entities: DataFrame, size: int, seed: str = "sample") -> DataFrame:
    """About size of the entities (ent, n_true): of those with 0, 1, 2 and more than 2 matches the same share each, rounded."""
    x = entities.withColumn("stratum", F.least("n_true", F.lit(3)))
    total = entities.count()
    if not 0 < size < total:
        return entities
    return ranked(x, "ent", ["stratum"], seed).filter(F.col("k") <= F.bround(F.col("n") * F.lit(size) / F.lit(total), 0)).select(*entities.columns)


def entity_folds(entities: DataFrame, k: int = 5, seed: str = "fold") -> DataFrame:
    """entities (ent, n_true) with fold: dealt in turn within the strata of 0, 1, 2 and more matches, or over all where a
    stratum has fewer than k."""
    x = entities.withColumn("stratum", F.least("n_true", F.lit(3)))
    least = x.groupBy("stratum").count().agg(F.min("count")).first()[0]
    by = x if (least or 0) >= k else x.withColumn("stratum", F.lit(0))
    return ranked(by, "ent", ["stratum"], seed).select(*entities.columns, ((F.col("k") - 1) % k).cast("long").alias("fold"))


def at_most(df: DataFrame, key: str, rows: int, seed: str = "cap") -> DataFrame:
    """rows of df at most, the first by the hash of key."""
    return df.orderBy(hashed(F.col(key), seed), key).limit(rows)


def thin(s1: DataFrame, truth: DataFrame, share: float, seed: str = "thin") -> tuple[DataFrame, DataFrame]:
    """s1 (id) without a share of its entities, and the truth (s1_id, rec_id) of those that stay: the others' records stay as
    distractors."""
    kept = s1.filter(unit(F.col("id"), seed) >= share) if share > 0 else s1
    return kept, truth.join(kept.select(F.col("id").alias("s1_id")), "s1_id", "left_semi")


def thinning_share(train: tuple[int, int], test: tuple[int, int], most: float = 0.5) -> float:
    """The share of training entities to leave out so that records an entity are as many as in the test: (entities, records)."""
    if not test[0] or not test[1]:
        return 0.0
    return min(max(1 - (train[1] / max(train[0], 1)) / (test[1] / test[0]), 0.0), most)


def in_states(s1: DataFrame, rec: DataFrame, truth: DataFrame, share: float, seed: str = "7") -> tuple[DataFrame, DataFrame, DataFrame]:
    """A share of whole states (column state, '' where unknown): their entities and those of no state; the records of those
    states and, of records without one, those of kept entities and a share of the unmatched. A record whose owner goes goes."""
    inside = lambda: (F.col("state") != "") & (unit(F.col("state"), seed) < share)
    present = s1.filter(inside()).select("state").distinct()
    kept = s1.join(present, "state", "left_semi").unionByName(s1.filter("state = ''"))
    owned = truth.filter("rec_id is not null").join(kept.select(F.col("id").alias("s1_id"), F.lit(True).alias("_stays")), "s1_id", "left").groupBy(F.col("rec_id").alias("id")).agg(F.max(F.coalesce("_stays", F.lit(False))).alias("_stays"))
    x = rec.join(owned, "id", "left").join(F.broadcast(present.withColumn("_in", F.lit(True))), "state", "left")
    known = F.col("state") != ""
    keep = F.when(known, F.coalesce("_in", F.lit(False))).when(F.col("_stays").isNotNull(), F.col("_stays")).otherwise(unit(F.col("id"), seed + "r") < share)
    records = x.filter(keep & F.coalesce("_stays", F.lit(True))).select(*rec.columns)
    pairs = truth.join(kept.select(F.col("id").alias("s1_id")), "s1_id", "left_semi").join(records.select(F.col("id").alias("rec_id")), "rec_id", "left_semi")
    return kept.select(*s1.columns), records, pairs.select(*truth.columns)


def in_countries(s1: DataFrame, rec: DataFrame, truth: DataFrame, countries: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities and records of some country keys (ckey), and the truth of those entities."""
    kept = s1.filter(F.col("ckey").isin(countries))
    return kept, rec.filter(F.col("ckey").isin(countries)), truth.join(kept.select(F.col("id").alias("s1_id")), "s1_id", "left_semi")


def training_pairs(pairs: DataFrame, least: float = 0.003, easy: float = 0.05, seed: str = "easy") -> DataFrame:
    """Pairs (p, label) a second judge learns from: true ones, those not clearly wrong, and a share of the others."""
    return pairs.filter((F.col("label") == 1) | (F.col("p") >= least) | (unit(F.concat_ws("|", "ent", "rec"), seed) < easy))


def touching(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """All pairs of the records that have a pair with one of the entities (ent)."""
    return pairs.join(pairs.join(entities.select("ent"), "ent", "left_semi").select("rec").distinct(), "rec", "left_semi")
