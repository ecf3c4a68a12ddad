"""Linkage queries as SQL that reads the same in Spark and in standard engines.

`pairs` is the scored candidate table: entity, record, score and label. Ties follow the other identifier."""

PAIRS = """pairs AS (
  SELECT l_orderkey AS ent, l_partkey AS rec, MAX(l_extendedprice) / CAST(110000 AS DOUBLE) AS p,
         MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS label
  FROM lineitem GROUP BY l_orderkey, l_partkey)"""

#: Entities without candidates count too; an empty truth and no selection score 1.
_SCORED = """per AS (
  SELECT ent, SUM(label) AS tp, COUNT(*) AS npred FROM sel GROUP BY ent),
truth AS (SELECT ent, SUM(label) AS n_true FROM pairs GROUP BY ent),
scored AS (
  SELECT o.o_orderkey AS ent, COALESCE(t.n_true, 0) AS n_true, COALESCE(s.npred, 0) AS npred, COALESCE(s.tp, 0) AS tp,
         CASE WHEN COALESCE(t.n_true, 0) = 0 AND COALESCE(s.npred, 0) = 0 THEN CAST(1 AS DOUBLE)
              WHEN COALESCE(s.tp, 0) = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST(1.25 AS DOUBLE) * s.tp / (CAST(0.25 AS DOUBLE) * t.n_true + s.npred) END AS f
  FROM orders o LEFT JOIN truth t ON t.ent = o.o_orderkey LEFT JOIN per s ON s.ent = o.o_orderkey)"""

_EXPECTED = """ranked AS (
  SELECT ent, rec, p, label, SUM(p) OVER (PARTITION BY ent) AS s,
         SUM(LN(1 - LEAST(p, CAST(0.9999999 AS DOUBLE)))) OVER (PARTITION BY ent) AS ln0 FROM pairs),
cum AS (
  SELECT *, SUM(p) OVER (PARTITION BY ent ORDER BY p DESC, rec ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c,
         ROW_NUMBER() OVER (PARTITION BY ent ORDER BY p DESC, rec) AS k FROM ranked WHERE p >= CAST(0.1 AS DOUBLE)),
ek AS (SELECT *, CAST(1.25 AS DOUBLE) * c / (CAST(0.25 AS DOUBLE) * s + k) AS e FROM cum),
best AS (SELECT *, MAX(e) OVER (PARTITION BY ent) AS top FROM ek),
cut AS (SELECT *, MIN(CASE WHEN e >= top - CAST(0.000000000001 AS DOUBLE) THEN k END) OVER (PARTITION BY ent) AS kstar FROM best),
sel AS (SELECT ent, rec, p, label FROM cut WHERE k <= kstar AND top > EXP(ln0))"""

_THRESHOLD = "sel AS (SELECT ent, rec, p, label FROM pairs WHERE p >= CAST(0.5 AS DOUBLE))"


def _sides(side: str, other: str) -> str:
    """Each pair among those of its side: sums are of exact decimals, the leader's ratio is 1, a lone pair's gap is its p."""
    w = f"PARTITION BY {side}"
    best = "CASE WHEN rnk = 1 THEN top2 ELSE top1 END"
    return f"""WITH {PAIRS}, st AS (
  SELECT {side}, {other}, CAST(ROUND(p, 6) AS DECIMAL(20, 6)) AS p, ROW_NUMBER() OVER ({w} ORDER BY p DESC, {other}) AS rnk FROM pairs),
full_st AS (SELECT *, MAX(p) OVER ({w}) AS top1, MAX(CASE WHEN rnk = 2 THEN p END) OVER ({w}) AS top2, COUNT(*) OVER ({w}) AS n,
  SUM(CASE WHEN p > 0.5 THEN 1 ELSE 0 END) OVER ({w}) AS c5, SUM(CASE WHEN p > 0.9 THEN 1 ELSE 0 END) OVER ({w}) AS c9, SUM(p) OVER ({w}) AS total FROM st)
SELECT {side}, {other}, CAST(rnk AS BIGINT) AS rnk, CAST(top1 AS DOUBLE) AS top1, CAST(top2 AS DOUBLE) AS top2, CAST(n AS BIGINT) AS n,
       CAST(c5 AS BIGINT) AS c5, CAST(c9 AS BIGINT) AS c9, CAST(total AS DOUBLE) AS total, CAST({best} AS DOUBLE) AS other,
       CAST(p - COALESCE({best}, 0) AS DOUBLE) AS gap, ROUND(CAST(p AS DOUBLE) / GREATEST(CAST(top1 AS DOUBLE), CAST(0.000001 AS DOUBLE)), 6) AS ratio,
       CAST(total - p AS DOUBLE) AS sum_other, CAST(c5 - CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS BIGINT) AS c5_other, CAST(c9 - CASE WHEN p > 0.9 THEN 1 ELSE 0 END AS BIGINT) AS c9_other
FROM full_st"""


QUERIES = {
    "macro_f05_exact": f"WITH {PAIRS}, {_THRESHOLD}, {_SCORED} SELECT CAST(COUNT(*) AS BIGINT) AS entities, CAST(SUM(npred) AS BIGINT) AS selected, CAST(SUM(tp) AS BIGINT) AS true_positives, ROUND(AVG(f), 6) AS macro_f05 FROM scored",
    "f05_breakdown": f"WITH {PAIRS}, {_THRESHOLD}, {_SCORED} SELECT CASE WHEN n_true = 0 THEN 'singleton' ELSE 'matched' END AS kind, CAST(COUNT(*) AS BIGINT) AS entities, ROUND(AVG(f), 6) AS macro_f05 FROM scored GROUP BY CASE WHEN n_true = 0 THEN 'singleton' ELSE 'matched' END",
    "select_threshold": f"WITH {PAIRS}, {_THRESHOLD} SELECT ent, rec, ROUND(p, 6) AS p, CAST(label AS BIGINT) AS label FROM sel",
    "select_expected_f": f"WITH {PAIRS}, {_EXPECTED} SELECT ent, rec, ROUND(p, 6) AS p, CAST(label AS BIGINT) AS label FROM sel",
    "expected_f_score": f"WITH {PAIRS}, {_EXPECTED}, {_SCORED} SELECT CAST(COUNT(*) AS BIGINT) AS entities, CAST(SUM(npred) AS BIGINT) AS selected, CAST(SUM(tp) AS BIGINT) AS true_positives, ROUND(AVG(f), 6) AS macro_f05 FROM scored",
    "record_argmax": f"WITH {PAIRS} SELECT ent, rec, ROUND(p, 6) AS p FROM (SELECT ent, rec, p, ROW_NUMBER() OVER (PARTITION BY rec ORDER BY p DESC, ent) AS k FROM pairs) x WHERE k = 1",
    "group_stats_record": _sides("rec", "ent"),
    "group_stats_entity": _sides("ent", "rec"),
    "customer_orders": "SELECT c.c_custkey, c.c_nationkey, CAST(COUNT(o.o_orderkey) AS BIGINT) AS n_true FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey, c.c_nationkey",
    "semi_anti_misses": "SELECT c_custkey, 'miss' AS kind FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey) UNION ALL SELECT c_custkey, 'kept' AS kind FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)",
    "recall_at_k": f"""WITH {PAIRS}, r AS (SELECT label, ROW_NUMBER() OVER (PARTITION BY rec ORDER BY p DESC, ent) AS k FROM pairs),
h AS (SELECT k, SUM(label) AS hits FROM r GROUP BY k)
SELECT CAST(k AS BIGINT) AS k, CAST(SUM(hits) OVER (ORDER BY k) AS BIGINT) AS found, ROUND(CAST(SUM(hits) OVER (ORDER BY k) AS DOUBLE) / CAST((SELECT SUM(label) FROM pairs) AS DOUBLE), 6) AS recall FROM h""",
    "loss_report": f"""WITH {PAIRS}, {_THRESHOLD}, e AS (
  SELECT p.ent, p.rec, CASE WHEN p.label = 1 AND s.rec IS NULL THEN 'FN' WHEN p.label = 0 AND s.rec IS NOT NULL THEN 'FP' END AS kind, p.p
  FROM pairs p LEFT JOIN sel s ON s.ent = p.ent AND s.rec = p.rec)
SELECT kind, CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(DISTINCT ent) AS BIGINT) AS entities, ROUND(AVG(p), 4) AS mean_p FROM e WHERE kind IS NOT NULL GROUP BY kind""",
    "hash_sample": "SELECT o_orderkey FROM orders WHERE SUBSTR(MD5(CONCAT('7:', CAST(o_orderkey AS VARCHAR(20)))), 1, 8) < '40000000'",
    "crosstab_margins": "SELECT COALESCE(CAST(quality AS VARCHAR(5)), 'all') AS quality, COALESCE(CAST(toxic AS VARCHAR(5)), 'all') AS toxic, CAST(COUNT(*) AS BIGINT) AS n FROM labels GROUP BY CUBE (quality, toxic)",
    "profile_source": "SELECT lang, CAST(COUNT(*) AS BIGINT) AS n, ROUND(AVG(CASE WHEN text LIKE '%@%' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6) AS with_at, CAST(MAX(n_chars) AS BIGINT) AS longest, CAST(COUNT(DISTINCT MD5(text)) AS BIGINT) AS texts, CAST(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY n_chars) AS DOUBLE) AS median_length, ROUND(AVG(CASE WHEN LENGTH(TRIM(text)) = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6) AS empty FROM documents GROUP BY lang",
    "id_lists_counts": f"WITH {PAIRS}, {_THRESHOLD} SELECT o.o_orderkey AS ent, CAST(COUNT(s.rec) AS BIGINT) AS n, MIN(s.rec) AS first_id, MAX(s.rec) AS last_id FROM orders o LEFT JOIN sel s ON s.ent = o.o_orderkey GROUP BY o.o_orderkey",
    "validate_submission": f"""WITH {PAIRS}, {_THRESHOLD}
SELECT 'unknown entity' AS violation, CAST(COUNT(*) AS BIGINT) AS n FROM sel LEFT JOIN orders ON o_orderkey = ent WHERE o_orderkey IS NULL
UNION ALL SELECT 'unknown record' AS violation, CAST(COUNT(*) AS BIGINT) AS n FROM sel LEFT JOIN part ON p_partkey = rec WHERE p_partkey IS NULL
UNION ALL SELECT 'duplicate pair' AS violation, CAST(COUNT(*) AS BIGINT) AS n FROM (SELECT ent, rec FROM sel GROUP BY ent, rec HAVING COUNT(*) > 1) d""",
}

#: Tables that each engine must offer.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
