"""Decision rules over scored pairs (ent, rec, p, label) and their search. A rule's score at every threshold comes from one
pass: an entity's score changes only where a pair passes, so differences are summed by threshold and added up."""

from __future__ import annotations

import statistics

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MODES = ("threshold", "expected_f")
#: Thresholds 0.02 to 0.98.
GRID = tuple(round(0.01 * i, 2) for i in range(2, 99))
#: Scores this close to the best count as one plateau; expected scores this close as equal.
PLATEAU, EQUAL = 5e-4, 1e-12


def best_of_record(pairs: DataFrame) -> DataFrame:
    """pairs with top: the greatest p of its record, ties by entity."""
    return pairs.withColumn("top", F.row_number().over(Window.partitionBy("rec").orderBy(F.desc("p"), "ent")) == 1)


def eligible(pairs: DataFrame, exclusive: bool) -> DataFrame:
    return best_of_record(pairs).filter("top").drop("top") if exclusive else pairs


def _expected(pairs: DataFrame, least: Column) -> DataFrame:
    """pairs of p >= least with k (place in its entity), take (how many of the first k are best taken by expected F) and tp (true
    ones among those). What is expected of an entity comes from all of its pairs."""
    every, rank = Window.partitionBy("ent"), Window.partitionBy("ent").orderBy(F.desc("p"), "rec")
    so_far = rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # sums of exact decimals: no order of rows changes them
    exact = F.col("p").cast("decimal(20,12)")
    none = F.exp(F.sum(F.log1p(-F.least(F.col("p"), F.lit(1 - 1e-7))).cast("decimal(30,15)")).over(every).cast("double"))
    x = pairs.withColumns({"s": F.sum(exact).over(every).cast("double"), "none": none}).filter(F.col("p") >= least)
    x = x.withColumns({"k": F.row_number().over(rank), "c": F.sum(exact).over(so_far).cast("double"), "hits": F.sum("label").over(so_far)})
    x = x.withColumn("e", 1.25 * F.col("c") / (0.25 * F.col("s") + F.col("k")))
    x = x.withColumn("most", F.max("e").over(so_far))
    before = F.coalesce(F.lag("most").over(rank), F.lit(-1.0))
    x = x.withColumn("first", F.max(F.when(F.col("e") > before + EQUAL, F.struct("k", "hits"))).over(so_far))
    some = F.col("most") > F.col("none")
    x = x.withColumns({"take": F.when(some, F.col("first.k")).otherwise(0), "tp": F.when(some, F.col("first.hits")).otherwise(0)})
    return x.drop("s", "none", "c", "e", "most", "hits", "first")


def select(pairs: DataFrame, mode: str, threshold: float, exclusive: bool = False) -> DataFrame:
    """The pairs that a rule takes."""
    pairs = eligible(pairs, exclusive)
    if mode == "threshold":
        return pairs.filter(F.col("p") >= threshold)
    if mode != "expected_f":
        raise ValueError(mode)
    ranked = _expected(pairs, F.lit(threshold))
    last = F.max_by("take", "k").over(Window.partitionBy("ent"))
    return ranked.withColumn("n", last).filter("k <= n").select(*pairs.columns)


def curves(pairs: DataFrame, truth: DataFrame, modes=MODES, exclusive=(False,), grid=GRID) -> DataFrame:
    """(fold, mode, exclusive, threshold, score, n_pred, entities): sums of F0.5 over a fold's entities at each threshold.
    truth: ent, n_true (found or not), fold. At most folds x modes x grid rows."""
    empty = truth.groupBy("fold").agg(F.count("*").alias("entities"), F.sum((F.col("n_true") == 0).cast("long")).alias("f0"))
    steps = F.array(*[F.lit(t) for t in grid])
    out = None
    for alone in exclusive:
        near = eligible(pairs, alone).withColumn("g", F.size(F.filter(steps, lambda t: t <= F.col("p"))))
        rank = Window.partitionBy("ent").orderBy(F.desc("p"), "rec")
        so_far = rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        for mode in modes:
            if mode == "expected_f":
                x = _expected(near, F.lit(grid[0]))
            else:
                x = near.filter("g > 0").withColumns({"k": F.row_number().over(rank), "tp": F.sum("label").over(so_far)}).withColumn("take", F.col("k"))
            # of each entity and threshold, the last pair that passes tells what is taken
            x = x.groupBy("ent", "g").agg(F.max_by(F.struct("take", "tp"), "k").alias("t"))
            x = x.join(truth, "ent").select("ent", "fold", "g", F.col("t.take").cast("long").alias("take"), F.when(F.col("t.tp") > 0, 1.25 * F.col("t.tp") / (0.25 * F.col("n_true") + F.col("t.take"))).otherwise(F.when((F.col("n_true") == 0) & (F.col("t.take") == 0), 1.0).otherwise(0.0)).alias("f"), F.when(F.col("n_true") == 0, 1.0).otherwise(0.0).alias("start"))
            down = Window.partitionBy("ent").orderBy(F.desc("g"))
            x = x.withColumns({"df": F.col("f") - F.coalesce(F.lag("f").over(down), F.col("start")), "dn": F.col("take") - F.coalesce(F.lag("take").over(down), F.lit(0))})
            sums = x.groupBy("fold", "g").agg(F.sum(F.col("df").cast("decimal(30,15)")).alias("df"), F.sum("dn").alias("dn"))
            every = empty.select("fold", "entities", "f0", F.posexplode(steps).alias("g", "threshold")).withColumn("g", F.col("g") + 1)
            every = every.join(sums, ["fold", "g"], "left").fillna({"dn": 0}).withColumn("df", F.coalesce("df", F.lit(0)))
            total = Window.partitionBy("fold").orderBy(F.desc("g")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
            part = every.select("fold", F.lit(mode).alias("mode"), F.lit(alone).alias("exclusive"), "threshold", (F.col("f0") + F.sum("df").over(total)).cast("double").alias("score"), F.sum("dn").over(total).alias("n_pred"), "entities")
            out = part if out is None else out.unionByName(part)
    return out


def _best(rows: list[tuple[str, bool, float, float, int]]) -> dict:
    """Of (mode, exclusive, threshold, score, n_pred): the first best, its threshold moved to the middle of the plateau."""
    top = max(rows, key=lambda r: r[3])
    same = [r for r in rows if r[:2] == top[:2]]
    middle = statistics.median(r[2] for r in same if r[3] >= top[3] - PLATEAU)
    chosen = min(same, key=lambda r: abs(r[2] - middle))
    return dict(zip(("mode", "exclusive", "threshold", "macro_f05", "n_pred"), chosen))


def search(curve: DataFrame) -> dict:
    """The best rule over all folds of curves(), a table of a few hundred rows."""
    rows = curve.groupBy("mode", "exclusive", "threshold").agg((F.sum("score") / F.sum("entities")).alias("f"), F.sum("n_pred").alias("n")).collect()
    order = {m: i for i, m in enumerate(MODES)}
    return _best(sorted(((r["mode"], r["exclusive"], r["threshold"], r["f"], r["n"]) for r in rows), key=lambda r: (r[1], order[r[0]], r[2])))


def nested(curve: DataFrame, every: int = 2) -> list[dict]:
    """For each fold the rule that is best on the others (each every-th threshold) and its score on the fold; last, fold None:
    the scores' mean by entities. Entities of the fold count as scored 1 while the others are tuned."""
    rows = curve.collect()
    grid = sorted({r.threshold for r in rows})[::every]
    order = {m: i for i, m in enumerate(MODES)}
    everyone = {r.fold: r.entities for r in rows}
    size, out = sum(everyone.values()), []
    for fold in sorted(everyone):
        tuned = []
        for key in sorted({(r.exclusive, order[r["mode"]], r["mode"]) for r in rows}):
            for t in grid:
                others = [r for r in rows if r.fold != fold and (r.exclusive, r["mode"], r.threshold) == (key[0], key[2], t)]
                tuned.append((key[2], key[0], t, (sum(r.score for r in others) + everyone[fold]) / size, sum(r.n_pred for r in others)))
        best = _best(tuned)
        own = next(r for r in rows if (r.fold, r.exclusive, r["mode"], r.threshold) == (fold, best["exclusive"], best["mode"], best["threshold"]))
        out.append({"fold": fold, "mode": best["mode"], "threshold": best["threshold"], "macro_f05": own.score / own.entities, "entities": own.entities})
    mean = sum(r["macro_f05"] * r["entities"] for r in out) / max(1, size)
    return [*out, {"fold": None, "mode": None, "threshold": None, "macro_f05": mean, "entities": size}]


def best_variant(scores: dict[str, float], final: str = "auto") -> str:
    """The variant of the best nested score, or the one asked for."""
    if final != "auto" and final not in scores:
        raise ValueError(f"variant {final} is not among {sorted(scores)}")
    return max(scores, key=scores.get) if final == "auto" else final


def predictions(taken: DataFrame) -> DataFrame:
    """(ent, recs): the records that a rule has taken, best first, each once."""
    best = taken.groupBy("ent", "rec").agg(F.max("p").alias("p"))
    return best.groupBy("ent").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("p")).alias("o"), "rec"))), lambda x: x["rec"]).alias("recs"))
