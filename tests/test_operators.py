"""Linkage operators against hand-made cases and brute force."""

import random

import numpy as np
import pytest
from kinspark.operators import blocking, decisions, features, learning, reports, sampling, vectors
from kinspark.plans.queries import QUERIES
from pyspark.sql import functions as F


def test_group_statistics(spark):
    rows = [(0, 10, 0.2), (0, 11, 0.9), (0, 12, 0.6), (1, 10, 0.7)]
    pairs = spark.createDataFrame(rows, "s1 int, rec int, p double")
    got = {(r.s1, r.rec): r for r in features.group_stats(pairs, "s1", "rec", "ent").collect()}
    lead, alone, last = got[0, 11], got[1, 10], got[0, 10]
    assert lead.ent_ratio == 1 and lead.ent_other == 0.6 and lead.ent_gap == pytest.approx(0.3) and lead.ent_c5_other == 1 and lead.ent_c9_other == 0
    assert alone.ent_gap == 0.7 and alone.ent_other is None and alone.ent_n == 1 and alone.ent_sum_other == 0
    assert last.ent_rank == 3 and last.ent_c5_other == 2 and last.ent_sum_other == pytest.approx(1.5)
    x = features.rank_and_gap(pairs, "s1", "rec", ["p"], "g")
    assert {(r.s1, r.rec): r.p_gap_g for r in x.collect()}[1, 10] is None


def test_neighbours_by_cells(spark):
    r = np.random.default_rng(1)
    centres = r.normal(size=(12, 16))
    x = centres[r.integers(0, 12, 900)] + 0.3 * r.normal(size=(900, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    exact = {(q.id, q.neighbour) for q in blocking.knn_exact(df, df, 10).collect()}
    found = {(q.id, q.neighbour) for q in blocking.knn_cells(df, df, 10, probes=6).collect()}
    assert len(exact) == 9000 and len(exact & found) >= 0.9 * len(exact)
    hot = spark.createDataFrame([(i, x[0].tolist()) for i in range(2500)], "id long, v array<double>")  # one cell of three blocks
    assert blocking.knn_cells(hot.filter("id < 3"), hot, 5).count() == 15
    assert blocking.knn_cells(df, df.limit(0), 5).count() == 0


def test_projection_keeps_likeness(spark):
    names = [f"{a} {b}" for a in ("blue market", "old bakery", "green tools") for b in ("one", "two", "three", "four")]
    s1 = spark.createDataFrame([("x", i, n) for i, n in enumerate(names)], "ckey string, id int, t string")
    sizes = spark.createDataFrame([("x", len(names))], "ckey string, n long")
    counts = vectors.gram_counts(s1, "t")
    vec = vectors.weighted(counts, vectors.gram_idf(counts, sizes), sizes)
    v = {r.id: np.array(r.v) for r in vectors.project(vec, vectors.fit_projection(vec, dim=6)).collect()}
    assert all(abs(np.linalg.norm(x) - 1) < 1e-6 for x in v.values()) and v[0] @ v[1] > v[0] @ v[5]
    pairs = spark.createDataFrame([(0, 0), (0, 11)], "s1 int, rec int")
    cos = {r.rec: r.c for r in vectors.pair_cosines(pairs, vec, vec, "c").collect()}
    assert cos[0] == pytest.approx(1) and cos[11] < 0.5


def brute_select(rows, mode, t):
    out = set()
    for ent in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == ent), key=lambda r: (-r[2], r[1]))
        if mode == "threshold":
            out |= {r[:2] for r in own if r[2] >= t}
            continue
        total, none = sum(r[2] for r in own), np.prod([1 - r[2] for r in own])
        e = [1.25 * sum(r[2] for r in own[:k]) / (0.25 * total + k) for k in range(1, sum(r[2] >= t for r in own) + 1)]
        if e and max(e) > none:
            out |= {r[:2] for r in own[: next(k for k, x in enumerate(e, 1) if x >= max(e) - 1e-12)]}
    return out


def test_selection_and_curves(spark):
    r = random.Random(3)
    rows = [(e, 100 * e + k, round(r.random(), 4), int(r.random() < 0.4)) for e in range(40) for k in range(r.randint(0, 6))]
    pairs = spark.createDataFrame(rows, "ent int, rec int, p double, label int")
    n = {e: sum(x[3] for x in rows if x[0] == e) + (e % 7 == 0) for e in range(40)}
    truth = spark.createDataFrame([(e, k, e % 3) for e, k in n.items()], "ent int, n_true int, fold int")
    curve = decisions.curves(pairs, truth).collect()
    for mode in decisions.MODES:
        for t in (0.05, 0.3, 0.62, 0.98):
            want = brute_select(rows, mode, t)
            assert {(x.ent, x.rec) for x in decisions.select(pairs, mode, t).collect()} == want
            score = 0.0
            for e in range(40):
                own = [x for x in rows if x[:2] in want and x[0] == e]
                tp = sum(x[3] for x in own)
                score += 1.0 if not own and not n[e] else 1.25 * tp / (0.25 * n[e] + len(own)) if tp else 0.0
            mine = [c for c in curve if c["mode"] == mode and c.threshold == t]
            assert sum(c.score for c in mine) == pytest.approx(score) and sum(c.n_pred for c in mine) == len(want)
    best = decisions.search(decisions.curves(pairs, truth))
    assert best["macro_f05"] >= max(sum(c.score for c in curve if (c["mode"], c.threshold) == (m, 0.3)) / 40 for m in decisions.MODES) - 5e-4
    found = decisions.nested(decisions.curves(pairs, truth))
    assert [f["fold"] for f in found] == [0, 1, 2, None] and sum(f["entities"] for f in found[:3]) == 40
    assert decisions.best_variant({"a": 0.5, "b": 0.6}) == "b" and decisions.best_variant({"a": 0.5, "b": 0.6}, "a") == "a"
    with pytest.raises(ValueError):
        decisions.best_variant({"a": 0.5}, "c")
    lists = {x.ent: x.recs for x in decisions.predictions(pairs).collect()}
    assert all(lists[e] == [x[1] for x in sorted((y for y in rows if y[0] == e), key=lambda y: (-y[2], y[1]))] for e in lists)
    rivals = spark.createDataFrame([(0, 1, 0.5), (1, 1, 0.5), (2, 1, 0.4), (2, 2, 0.1)], "ent int, rec int, p double")
    assert {(x.ent, x.rec) for x in decisions.eligible(rivals, True).collect()} == {(0, 1), (2, 2)}


def test_sampling(spark):
    ents = spark.createDataFrame([(f"e{i}", i % 5) for i in range(400)], "ent string, n_true int")
    got = sampling.sample_entities(ents, 100).collect()
    assert sorted(sum(min(r.n_true, 3) == s for r in got) for s in range(4)) == [20, 20, 20, 40]
    folds = sampling.entity_folds(ents, 5).collect()
    assert len(folds) == 400 and all(sum(r.fold == f for r in folds if r.n_true == 0) == 16 for f in range(5))
    few = sampling.entity_folds(ents.limit(7), 5).collect()
    assert sorted(r.fold for r in few) == [0, 0, 1, 1, 2, 3, 4]
    assert sampling.at_most(ents, "ent", 10).count() == 10 and sampling.thinning_share((100, 400), (100, 800)) == 0.5 and sampling.thinning_share((1, 9), (0, 0)) == 0.0
    s1 = spark.createDataFrame([(f"s{i}",) for i in range(100)], "id string")
    truth = spark.createDataFrame([(f"s{i}", f"r{i}") for i in range(100)], "s1_id string, rec_id string")
    kept, pairs = sampling.thin(s1, truth, 0.3)
    assert 50 < kept.count() < 90 and pairs.count() == kept.count()


def test_models(spark, tmp_path):
    r = random.Random(5)
    rows = [(i % 60, i, float(x := r.random()), None if i % 9 == 0 else float(r.random()), int(x > 0.5)) for i in range(600)]
    df = spark.createDataFrame(rows, "ent int, rec int, a double, b double, y int")
    got = learning.out_of_fold(df, "ent", "y", ["a", "b"], k=3, rounds=3, depth=2)
    assert got.columns == [*df.columns, "fold", "p"] and got.filter((F.col("p") > 0.5) != (F.col("y") == 1)).count() < 60
    folded = df.withColumn("fold", learning.fold_of(F.col("ent"), 3))
    models = learning.fit_folds(folded, "y", ["a", "b"], 3, 2, 2)
    learning.save_bundle(spark, str(tmp_path / "bundle"), models, ["a", "b"], {"mode": "threshold", "threshold": 0.5})
    again, about = learning.load_bundle(spark, str(tmp_path / "bundle"))
    assert about["features"] == ["a", "b"] and about["rule"]["threshold"] == 0.5
    mean = {x.rec: x.p for x in learning.ensemble(models, folded, ["a", "b"]).collect()}
    assert mean == {x.rec: x.p for x in learning.ensemble(again, folded, ["a", "b"]).collect()}
    competing = df.withColumn("fold", F.when(F.col("rec") % 2 == 0, 1).cast("int"))
    got = {x.rec: (x.fold, x.p) for x in learning.score_out_of_fold(models, competing, ["a", "b"]).collect()}
    assert all(p == mean[i] for i, (f, p) in got.items() if f is None)
    assert {x.rec: x.fold for x in learning.record_folds(spark.createDataFrame([(1, 0), (1, 0), (2, 0), (2, 1)], "rec int, fold int")).collect()} == {1: 0, 2: None}
    shares = learning.gains(models, ["a", "b"])
    assert len(shares) == 6 and all(g > 0.5 for _, f, g in shares if f == "a")


def test_loss_tags(spark):
    s1 = spark.createDataFrame([("S1-1", "Blue Inn", "1 Rd"), ("S1-2", "Blue-Inn", "")], "id string, name string, address string")
    rec = spark.createDataFrame([("S2-1", "Blue Inn", " "), ("S2-2", "नीला", "9 Rd"), ("S2-3", "Blue In", "x")], "id string, name string, address string")
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-2", None)], "s1_id string, rec_id string")
    pairs = spark.createDataFrame([("S1-1", "S2-1", 0.9, 1, True), ("S1-1", "S2-3", 0.8, 0, True), ("S1-2", "S2-1", 0.7, 0, True)], "s1 string, rec string, p double, label int, taken boolean")
    lost = reports.losses(pairs, truth, reports.true_counts(s1, truth))
    got = {(r.kind, r.s1, r.rec): r for r in reports.tagged(lost, s1, rec, truth).collect()}
    assert got["FP", "S1-1", "S2-3"].tags == "addr latin name_shared sim>=85 distractor"
    assert got["FP", "S1-2", "S2-1"].tags == "no_addr latin name_shared sim>=85 other_owner" and got["FP", "S1-2", "S2-1"].pts == 1.0
    assert got["MISS", "S1-1", "S2-2"].tags == "addr native name_shared sim<50" and got["MISS", "S1-1", "S2-2"].p is None


def test_all_features(spark, sf):
    """Every one of the features is there, in bounds, and unknown exactly where a side is missing."""
    x = QUERIES["pair_features"](spark, sf)
    assert len(x.columns) == 2 + 118
    low = x.select(*[F.min(c).alias(c) for c in x.columns if c.endswith(("_eq", "_ratio", "_tset", "_jw"))]).first()
    assert all(v is None or v >= 0 for v in low)
    assert x.filter("house_eq is null and addr_len1 > 0 and addr_len2 > 0").count() == 0 and x.filter("addr_len2 = 0 and addr_ratio is not null").count() == 0
    assert x.filter("cheap_rank_rec = 1 and cheap_gap_rec < 0").count() == 0 and x.select("rec", "s1").distinct().count() == x.count()
