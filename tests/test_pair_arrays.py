"""Features of pairs by arrays against those of joined pairs."""

import math
import random

from kinspark.functions import metrics
from kinspark.operators import features, pair_arrays
from kinspark.plans import linkage
from pyspark.sql import functions as F


def _rows(df):
    return {(r.rec, r.s1): r for r in df.collect()}


def test_same_features_as_joined(spark, sf, monkeypatch):
    s1, rec, _, sizes = linkage.prepared(spark, sf)
    cand = linkage.four_way_candidates(spark, sf).filter("kept")
    some = cand.filter("pmod(xxhash64(rec), 4) = 0").unionByName(cand.limit(1).withColumn("s1", F.lit("S1-none")))
    # an unknown country and missing parts too
    odd = F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(9))
    rec = rec.withColumns({"ckey": F.when(odd == 0, "nowhere").otherwise(F.col("ckey")), "addr_n": F.when(odd == 1, "").otherwise(F.col("addr_n")), "core": F.when(odd == 2, "").otherwise(F.col("core")), "core_toks": F.when(odd == 3, F.array(F.lit("नया"), F.lit("x"), F.lit("x"))).otherwise(F.col("core_toks"))})
    want = features.compute_by_record(some, s1, rec, sizes, most=1)
    monkeypatch.setattr(pair_arrays, "RECORDS", 37)
    got = features.compute_by_record(some, s1, rec, sizes)
    assert got.schema == want.schema and len(got.columns) == 2 + 118
    want, got = _rows(want), _rows(got)
    assert set(want) == set(got) and len(want) > 1000
    for pair, row in want.items():
        for c in row.__fields__:
            x, y = row[c], got[pair][c]
            assert x == y or x is not None and y is not None and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), (pair, c, x, y)


def test_no_pair_is_joined_with_texts(spark, sf):
    s1, rec, _, sizes = linkage.prepared(spark, sf)
    made = features.compute_by_record(linkage.four_way_candidates(spark, sf).filter("kept"), s1, rec, sizes)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "ArrowEvalPython" not in plan and plan.count("Join") == 1


def test_levenshtein_of_many():
    rng = random.Random(3)
    a, b = (["".join(rng.choices("01a", k=rng.randint(0, 9))) for _ in range(3000)] for _ in range(2))

    def one(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            old, row[0] = row[0], i
            for j, d in enumerate(y, 1):
                old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (c != d))
        return row[-1]

    assert metrics.levenshteins(a, b) == [one(x, y) for x, y in zip(a, b)]


def test_features_in_the_workers_of_candidates(spark, sf):
    s1, rec, _, sizes = linkage.prepared(spark, sf)
    made = linkage.pair_features(spark, sf)
    assert "Aggregate" not in made._jdf.queryExecution().executedPlan().toString()  # no pair is gathered by its record
    apart = features.compute_by_record(linkage.four_way_candidates(spark, sf).filter("kept"), s1, rec, sizes)
    assert made.schema.simpleString() == apart.schema.simpleString()
    want, got = _rows(apart), _rows(made)
    assert set(want) == set(got) and len(want) > 5000 and {r.rec_source for r in got.values()} == {2.0, 3.0}
    differ = sum(x != y and not (x is not None and y is not None and math.isclose(x, y, abs_tol=1e-6)) for pair, row in want.items() for x, y in zip(row[2:], got[pair][2:]))
    assert differ <= len(want) / 1000  # places of neighbours whose likenesses differ by less than a hundred-thousandth
