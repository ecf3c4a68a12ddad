"""Blocking, feature and decision queries as SQL. Parts that the engines spell differently are named in braces and filled in
for each: words (of a text column), list unnesting and regular replacement."""

from __future__ import annotations

from .linkage_sql import PAIRS

SPARK = {"WORDS": "EXPLODE(SPLIT(LOWER(text), '[^\\\\p{L}\\\\p{N}]+'))", "FIGURES": "EXPLODE(SPLIT(text, '[^0-9]+'))", "URLKEY": "REGEXP_REPLACE(LOWER(url), '[^0-9a-z]', '')", "GRID": "EXPLODE(SEQUENCE(1, 97))"}
STANDARD = {"WORDS": "UNNEST(string_split_regex(LOWER(text), '[^\\p{L}\\p{N}]+'))", "FIGURES": "UNNEST(string_split_regex(text, '[^0-9]+'))", "URLKEY": "REGEXP_REPLACE(LOWER(url), '[^0-9a-z]', '', 'g')", "GRID": "UNNEST(RANGE(1, 98))"}

_DOCUMENT_WORDS = "dw AS (SELECT DISTINCT doc_id, lang, tok FROM (SELECT doc_id, lang, {WORDS} AS tok FROM documents) x WHERE LENGTH(tok) >= 2)"
_ITEM_WORDS = "iw AS (SELECT DISTINCT item_id, tok FROM (SELECT item_id, {WORDS} AS tok FROM benchmark) x WHERE LENGTH(tok) >= 2)"
#: Words of 100 benchmark items at most, with ln((N + 1) / df).
_KEYS = f"""{_ITEM_WORDS},
keys AS (SELECT tok, COUNT(*) AS df, LN(CAST((SELECT COUNT(*) FROM benchmark) + 1 AS DOUBLE) / COUNT(*)) AS idf FROM iw GROUP BY tok HAVING COUNT(*) <= 100)"""
_OVERLAP = f"""{_DOCUMENT_WORDS}, {_KEYS},
ik AS (SELECT iw.item_id, iw.tok, keys.idf FROM iw JOIN keys ON keys.tok = iw.tok),
overlap AS (SELECT dw.doc_id, ik.item_id, SUM(ik.idf) AS score, COUNT(*) AS n_shared FROM dw JOIN ik ON ik.tok = dw.tok GROUP BY dw.doc_id, ik.item_id),
ranked AS (SELECT doc_id, item_id, score, n_shared, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY ROUND(score, 6) DESC, item_id) AS rnk FROM overlap)"""

#: Each pair falls into the highest threshold (0.01 to 0.97 by 0.01) that it passes; sums of F over entities change there
#: alone, so the whole grid takes one pass and no product with the thresholds.
_GRID = f"""WITH {PAIRS},
b AS (SELECT ent, CAST(LEAST(FLOOR(p * 100), 97) AS BIGINT) AS g, SUM(label) AS tp, COUNT(*) AS n FROM pairs GROUP BY ent, CAST(LEAST(FLOOR(p * 100), 97) AS BIGINT)),
c AS (SELECT ent, g, SUM(tp) OVER (PARTITION BY ent) AS n_true,
        SUM(tp) OVER (PARTITION BY ent ORDER BY g DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ctp,
        SUM(n) OVER (PARTITION BY ent ORDER BY g DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn FROM b),
f AS (SELECT ent, g, n_true, CASE WHEN ctp = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(1.25 AS DOUBLE) * ctp / (CAST(0.25 AS DOUBLE) * n_true + cn) END AS f FROM c),
d AS (SELECT g, f - COALESCE(LAG(f) OVER (PARTITION BY ent ORDER BY g DESC), CASE WHEN n_true = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS delta FROM f),
s AS (SELECT g, SUM(delta) AS delta FROM (SELECT g, delta FROM d UNION ALL SELECT {{GRID}} AS g, CAST(0 AS DOUBLE) AS delta) u GROUP BY g),
t AS (SELECT COUNT(*) AS entities FROM orders),
z AS (SELECT SUM(CASE WHEN COALESCE(q.n_true, 0) = 0 THEN 1 ELSE 0 END) AS f0 FROM orders LEFT JOIN (SELECT ent, SUM(label) AS n_true FROM pairs GROUP BY ent) q ON q.ent = o_orderkey)
SELECT CAST(g AS BIGINT) AS threshold_percent,
       ROUND((CAST(f0 AS DOUBLE) + SUM(delta) OVER (ORDER BY g DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / entities, 6) AS macro_f05
FROM s CROSS JOIN t CROSS JOIN z WHERE g >= 1"""

TEMPLATES = {
    "token_idf": f"WITH {_DOCUMENT_WORDS}, n AS (SELECT lang, COUNT(*) AS n FROM documents GROUP BY lang) SELECT dw.lang, dw.tok, CAST(COUNT(*) AS BIGINT) AS df, ROUND(LN(CAST(MAX(n.n) + 1 AS DOUBLE) / (COUNT(*) + 1)) + 1, 6) AS idf FROM dw JOIN n ON n.lang = dw.lang GROUP BY dw.lang, dw.tok",
    "key_df_pruned": f"WITH {_KEYS} SELECT tok, CAST(df AS BIGINT) AS df, ROUND(idf, 6) AS idf FROM keys",
    "key_overlap_join": f"WITH {_OVERLAP} SELECT item_id, CAST(COUNT(*) AS BIGINT) AS n_documents, CAST(SUM(n_shared) AS BIGINT) AS n_shared, ROUND(AVG(score), 4) AS mean_score FROM overlap GROUP BY item_id",
    "key_topk": f"WITH {_OVERLAP} SELECT doc_id, item_id, CAST(n_shared AS BIGINT) AS n_shared, ROUND(score, 4) AS score, CAST(rnk AS BIGINT) AS rnk FROM ranked WHERE rnk <= 15",
    "token_overlap_features": f"""WITH {_OVERLAP},
one AS (SELECT doc_id, item_id, n_shared, score FROM ranked WHERE rnk = 1),
dn AS (SELECT doc_id, COUNT(*) AS n FROM dw GROUP BY doc_id),
im AS (SELECT item_id, COUNT(*) AS n, SUM(idf) AS w FROM ik GROUP BY item_id)
SELECT one.doc_id, one.item_id, CAST(one.n_shared AS BIGINT) AS common, CAST(dn.n - one.n_shared AS BIGINT) AS only1, CAST(im.n - one.n_shared AS BIGINT) AS only2,
       ROUND(one.score, 4) AS winter, ROUND(one.score / im.w, 4) AS wcont2, ROUND(CAST(one.n_shared AS DOUBLE) / (dn.n + im.n - one.n_shared), 6) AS jaccard
FROM one JOIN dn ON dn.doc_id = one.doc_id JOIN im ON im.item_id = one.item_id""",
    "figure_counts": """WITH f AS (SELECT DISTINCT doc_id, num FROM (SELECT doc_id, {FIGURES} AS num FROM documents) x WHERE LENGTH(num) > 0),
n AS (SELECT num, COUNT(*) AS df FROM f GROUP BY num)
SELECT f.doc_id, CAST(SUM(CASE WHEN n.df > 1 THEN 1 ELSE 0 END) AS BIGINT) AS common, CAST(SUM(CASE WHEN n.df = 1 THEN 1 ELSE 0 END) AS BIGINT) AS lone
FROM f JOIN n ON n.num = f.num GROUP BY f.doc_id""",
    "simple_key": "SELECT page_id, {URLKEY} AS url_key FROM pages",
    "name_frequency": "SELECT p_name, CAST(COUNT(*) AS BIGINT) AS n, ROUND(LN(CAST(1 + COUNT(*) AS DOUBLE)), 6) AS name_freq FROM part GROUP BY p_name",
    "levenshtein_pairs": "SELECT a.n_nationkey AS a, b.n_nationkey AS b, CAST(LEVENSHTEIN(a.n_name, b.n_name) AS BIGINT) AS distance FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey",
    "quantiles": "SELECT event_type, ROUND(PERCENTILE_CONT(0.1) WITHIN GROUP (ORDER BY value), 6) AS p10, ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY value), 6) AS median, ROUND(AVG(value), 6) AS mean FROM events GROUP BY event_type",
    "id_collisions": "SELECT c_custkey AS id FROM customer INTERSECT SELECT s_suppkey AS id FROM supplier",
    "decision_grid": _GRID,
    "oof_logloss_auc": f"""WITH {PAIRS},
q AS (SELECT label, p, CAST(FLOOR(p * 1000) AS BIGINT) AS g FROM (SELECT label, LEAST(GREATEST(p, CAST(0.000001 AS DOUBLE)), CAST(0.999999 AS DOUBLE)) AS p FROM pairs) x),
v AS (SELECT g, p, COUNT(*) AS n, SUM(label) AS pos FROM q GROUP BY g, p),
below AS (SELECT g, SUM(n) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS n FROM (SELECT g, SUM(n) AS n FROM v GROUP BY g) y),
r AS (SELECT v.p, v.n, v.pos, below.n + SUM(v.n) OVER (PARTITION BY v.g ORDER BY v.p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - v.n + CAST(v.n + 1 AS DOUBLE) / 2 AS place FROM v JOIN below ON below.g = v.g)
SELECT CAST(SUM(n) AS BIGINT) AS n, ROUND(SUM(-pos * LN(p) - (n - pos) * LN(1 - p)) / SUM(n), 6) AS logloss,
       ROUND((SUM(pos * place) - CAST(SUM(pos) AS DOUBLE) * (SUM(pos) + 1) / 2) / (CAST(SUM(pos) AS DOUBLE) * (SUM(n) - SUM(pos))), 6) AS auc FROM r""",
    "submission_differences": f"WITH {PAIRS} SELECT ent AS id, 'seen only' AS kind FROM (SELECT ent FROM pairs EXCEPT SELECT o_orderkey FROM orders) a UNION ALL SELECT id, 'required only' AS kind FROM (SELECT o_orderkey AS id FROM orders EXCEPT SELECT ent FROM pairs) b",
}


def filled(words: dict[str, str]) -> dict[str, str]:
    out = {}
    for name, sql in TEMPLATES.items():
        for k, v in words.items():
            sql = sql.replace("{" + k + "}", v)
        out[name] = sql
    return out
