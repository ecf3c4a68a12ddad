"""SQL for a standard engine (DuckDB) of the queries of linkage.py, from the parts of roles.py."""

from __future__ import annotations

from .linkage_sql import PAIRS
from .roles import BOTH, PREPARED, RAW

_READY = f"""WITH {BOTH}, {PREPARED},
sizes AS (SELECT ckey, COUNT(*) AS n FROM prepared WHERE source = 1 GROUP BY ckey)"""

_LISTS = """lists AS (SELECT *, string_split(core, ' ') AS ct, CASE WHEN addr_n = '' THEN [] ELSE string_split(addr_n, ' ') END AS adt,
  CASE WHEN addr_nums = '' THEN [] ELSE string_split(addr_nums, ' ') END AS an FROM prepared),
placed AS (SELECT *, ct[1] AS t1, ct[2] AS t2, list_transform(list_filter(list_zip(adt, range(1, len(adt) + 1)), lambda z: length(z[1]) >= 4 AND regexp_full_match(z[1], '[a-z]+') AND list_position(adt, z[1]) = z[2]), lambda z: z[1]) AS pl FROM lists)"""

_KEYS = f"""{_LISTS},
keyed AS (SELECT DISTINCT ckey, source, id, unnest(list_concat(['t|' || t1, 't|' || t2, 'p|' || least(t1, t2) || '|' || greatest(t1, t2), 'c|' || compact],
    CASE WHEN house <> '' THEN ['hs|' || house || '|' || street, 'mh|' || meta_first || '|' || house, 'sf|' || street || '|' || first_tok] ELSE [] END,
    CASE WHEN postal <> '' THEN ['pf|' || postal || '|' || first_tok, 'mp|' || meta_first || '|' || postal] ELSE [] END,
    list_transform(list_filter(range(1, least(len(adt), 14)), lambda i: length(adt[i]) + length(adt[i + 1]) >= 5), lambda i: 'ab|' || adt[i] || '|' || adt[i + 1]),
    list_transform(an[1:3], lambda x: 'ac|' || initials || '|' || x),
    list_transform(pl[1:10], lambda x: 'na|' || compact || '|' || x), list_transform(list_filter(pl[1:10], lambda x: x <> t1), lambda x: 'fa|' || t1 || '|' || x))) AS key FROM placed)"""

_CAND = f"""{_KEYS},
idf AS (SELECT k.ckey, k.key, ln((any_value(z.n) + 1.0) / COUNT(*)) AS idf FROM keyed k JOIN sizes z ON z.ckey = k.ckey WHERE k.source = 1 GROUP BY k.ckey, k.key HAVING COUNT(*) <= 100),
met AS (SELECT r.id AS rec, s.id AS s1, SUM(idf.idf) AS score FROM keyed r JOIN idf ON idf.ckey = r.ckey AND idf.key = r.key JOIN keyed s ON s.source = 1 AND s.ckey = r.ckey AND s.key = r.key WHERE r.source > 1 GROUP BY r.id, s.id),
cand AS (SELECT * FROM (SELECT rec, s1, score, row_number() OVER (PARTITION BY rec ORDER BY round(score, 6) DESC, s1) AS key_rank FROM met) WHERE key_rank <= 15)"""


def _space(col: str, to: str) -> str:
    """Cosines of the character 3-grams of a column."""
    return f"""g_{to} AS (SELECT ckey, source, id, gram, 1 + ln(COUNT(*)) AS tf FROM (SELECT ckey, source, id, unnest(list_transform(range(1, length(w) + 1), lambda i: substr(' ' || w || ' ', i, 3))) AS gram
  FROM (SELECT ckey, source, id, unnest(string_split({col}, ' ')) AS w FROM whole) WHERE w <> '') GROUP BY ckey, source, id, gram),
i_{to} AS (SELECT g.ckey, gram, ln((any_value(z.n) + 1.0) / (COUNT(*) + 1.0)) + 1 AS idf FROM g_{to} g JOIN sizes z ON z.ckey = g.ckey WHERE source = 1 GROUP BY g.ckey, gram),
w_{to} AS (SELECT g.id, g.gram, g.tf * coalesce(i.idf, ln(z.n + 1.0) + 1) AS w FROM g_{to} g JOIN sizes z ON z.ckey = g.ckey LEFT JOIN i_{to} i ON i.ckey = g.ckey AND i.gram = g.gram),
n_{to} AS (SELECT id, sqrt(SUM(w * w)) AS norm FROM w_{to} GROUP BY id),
c_{to} AS (SELECT c.rec, c.s1, SUM(a.w * b.w) / (any_value(x.norm) * any_value(y.norm)) AS v FROM cand c JOIN w_{to} a ON a.id = c.s1 JOIN w_{to} b ON b.id = c.rec AND b.gram = a.gram JOIN n_{to} x ON x.id = c.s1 JOIN n_{to} y ON y.id = c.rec GROUP BY c.rec, c.s1)"""


_COS = f"""{_CAND}, whole AS (SELECT *, trim(core || ' ' || addr_n) AS everything FROM prepared),
{_space('core', 'name')}, {_space('everything', 'full')}, {_space('addr_n', 'addr')},
cosines AS (SELECT c.*, coalesce(x.v, 0.0) AS cos_name_c, coalesce(y.v, 0.0) AS cos_full_c, coalesce(z.v, 0.0) AS cos_addr_c FROM cand c
  LEFT JOIN c_name x ON x.rec = c.rec AND x.s1 = c.s1 LEFT JOIN c_full y ON y.rec = c.rec AND y.s1 = c.s1 LEFT JOIN c_addr z ON z.rec = c.rec AND z.s1 = c.s1)"""

_CAP = f"""{_COS},
cheap AS (SELECT rec, s1, key_rank, round(score, 4) AS key_score, round(cos_addr_c, 4) AS ca, round(0.3 * round(cos_name_c, 4) + 0.3 * round(cos_full_c, 4) + 0.25 * round(cos_addr_c, 4) + 0.15 * tanh(round(score, 4) / 10.0) + 0.01, 6) AS cheap FROM cosines),
ranks AS (SELECT *, row_number() OVER (PARTITION BY rec ORDER BY cheap DESC, s1) AS cheap_rank, row_number() OVER (PARTITION BY rec ORDER BY ca DESC, s1) AS ar FROM cheap),
capped AS (SELECT r.*, cheap_rank <= CASE WHEN p.addr_n = '' THEN 6 ELSE 3 END OR (ar <= 2 AND ca >= 0.5) OR key_rank <= 1 AS kept FROM ranks r JOIN prepared p ON p.id = r.rec)"""

_SCORED = f"""{_CAP},
scored AS (SELECT c.rec, c.s1, c.cheap_rank, c.kept, c.cheap AS p, CASE WHEN q.owner = c.s1 THEN 1 ELSE 0 END AS label, c.kept AND c.cheap >= 0.6 AS taken FROM capped c JOIN prepared q ON q.id = c.rec),
counts AS (SELECT e.id AS s1, COUNT(r.id) AS n_true FROM prepared e LEFT JOIN prepared r ON r.owner = e.id WHERE e.source = 1 GROUP BY e.id)"""

_F = lambda tp, t, n: f"CASE WHEN 0.25 * {t} + {n} > 0 THEN CAST(1.25 AS DOUBLE) * {tp} / (0.25 * {t} + {n}) ELSE CAST(1 AS DOUBLE) END"
_GAINS = f"""{_SCORED},
per AS (SELECT s1, SUM(CASE WHEN taken THEN label ELSE 0 END) AS tp, SUM(CASE WHEN taken THEN 1 ELSE 0 END) AS n_pred, SUM(CASE WHEN taken THEN 0 ELSE label END) AS n_fn, SUM(label) AS found FROM scored WHERE kept GROUP BY s1),
sums AS (SELECT c.s1, n_true, coalesce(tp, 0) AS tp, coalesce(n_pred, 0) AS n_pred, coalesce(n_fn, 0) AS n_fn, coalesce(n_pred - tp, 0) AS n_fp, greatest(n_true - coalesce(found, 0), 0) AS n_miss FROM counts c LEFT JOIN per ON per.s1 = c.s1),
gains AS (SELECT *, {_F('tp', 'n_true', 'n_pred')} AS f, {_F('tp', 'n_true', 'tp')} - {_F('tp', 'n_true', 'n_pred')} AS gain_fp,
  {_F('(tp + n_fn)', 'n_true', '(n_pred + n_fn)')} - {_F('tp', 'n_true', 'n_pred')} AS gain_fn, {_F('(tp + n_miss)', 'n_true', '(n_pred + n_miss)')} - {_F('tp', 'n_true', 'n_pred')} AS gain_miss FROM sums)"""

_LOST = f"""{_GAINS},
lost AS (SELECT 'FP' AS kind, x.s1, rec, p, gain_fp / greatest(n_fp, 1) AS pts FROM scored x JOIN gains g ON g.s1 = x.s1 WHERE kept AND taken AND label = 0
  UNION ALL SELECT 'FN', x.s1, rec, p, gain_fn / greatest(n_fn, 1) FROM scored x JOIN gains g ON g.s1 = x.s1 WHERE kept AND NOT taken AND label = 1
  UNION ALL SELECT 'MISS', g.s1, r.id, NULL, gain_miss / greatest(n_miss, 1) FROM prepared r JOIN gains g ON g.s1 = r.owner WHERE NOT EXISTS (SELECT 1 FROM scored x WHERE x.kept AND x.rec = r.id AND x.s1 = r.owner))"""

_RAW_NAME = "trim(upper(core) || CASE WHEN legal = '' THEN '' ELSE ' ' || legal || '.' END)"
_KEYNAME = "regexp_replace(lower(core || legal), '[^0-9a-z]', '', 'g')"


def _overlap(prefix: str, kind: str) -> str:
    """Ten columns of two records' words of a kind."""
    n = f"coalesce(c_{kind}.n, 0)"
    w = f"coalesce(c_{kind}.w, 0)"
    a, b = f"x_{kind}", f"y_{kind}"
    na, nb, wa, wb = (f"coalesce({t}, 0)" for t in (f"{a}.n", f"{b}.n", f"{a}.w", f"{b}.w"))
    none = f"{na} + {nb} = 0"
    cols = {
        "common": n, "only1": f"CASE WHEN {none} THEN NULL ELSE {na} - {n} END", "only2": f"CASE WHEN {none} THEN NULL ELSE {nb} - {n} END", "wjac": f"CASE WHEN {wa} + {wb} - {w} > 0 THEN {w} / ({wa} + {wb} - {w}) END",
        "wcont1": f"CASE WHEN {wa} > 0 THEN {w} / {wa} END", "wcont2": f"CASE WHEN {wb} > 0 THEN {w} / {wb} END", "winter": w, "wonly1": f"{wa} - {w}", "wonly2": f"{wb} - {w}", "wmaxonly": f"greatest({wa}, {wb}) - {w}",
    }
    kept = list(cols)[:3] if prefix.startswith("num") else list(cols)
    return ", ".join(f"round(CAST({cols[k]} AS DOUBLE), 5) AS {prefix}_{k}" for k in kept)


def _sides(kind: str) -> tuple[str, str]:
    ctes = f"""t_{kind} AS (SELECT id, COUNT(*) AS n, SUM(w) AS w FROM weighed WHERE kind = '{kind}' GROUP BY id),
c_{kind} AS (SELECT c.rec, c.s1, COUNT(*) AS n, SUM(a.w) AS w FROM cand c JOIN weighed a ON a.kind = '{kind}' AND a.id = c.s1 JOIN weighed b ON b.kind = '{kind}' AND b.id = c.rec AND b.tok = a.tok GROUP BY c.rec, c.s1)"""
    return ctes, f"LEFT JOIN t_{kind} x_{kind} ON x_{kind}.id = c.s1 LEFT JOIN t_{kind} y_{kind} ON y_{kind}.id = c.rec LEFT JOIN c_{kind} ON c_{kind}.rec = c.rec AND c_{kind}.s1 = c.s1"


_KINDS = {"tok_name": "name", "tok_addr": "addr", "tok_full": "full", "num_addr": "an", "num_name": "nn"}
_OVERLAPS = f"""{_READY}, {_CAND},
words AS (SELECT DISTINCT * FROM (SELECT ckey, source, id, 'name' AS kind, unnest(string_split(core, ' ')) AS tok FROM prepared UNION ALL SELECT ckey, source, id, 'addr', unnest(string_split(addr_n, ' ')) FROM prepared
  UNION ALL SELECT ckey, source, id, 'full', unnest(string_split(core || ' ' || addr_n, ' ')) FROM prepared UNION ALL SELECT ckey, source, id, 'an', unnest(string_split(addr_nums, ' ')) FROM prepared UNION ALL SELECT ckey, source, id, 'nn', name_nums FROM prepared) WHERE tok <> ''),
df AS (SELECT w.ckey, kind, tok, ln((any_value(n) + 1.0) / (COUNT(*) + 1.0)) + 1 AS idf FROM words w JOIN sizes z ON z.ckey = w.ckey WHERE source = 1 AND kind IN ('name', 'addr') GROUP BY w.ckey, kind, tok),
weighed AS (SELECT w.id, w.kind, w.tok, CASE w.kind WHEN 'name' THEN coalesce(a.idf, ln(n + 1.0) + 1) WHEN 'addr' THEN coalesce(b.idf, ln(n + 1.0) + 1) ELSE coalesce(a.idf, b.idf, ln(n + 1.0) + 1) END AS w
  FROM words w JOIN sizes z ON z.ckey = w.ckey LEFT JOIN df a ON a.kind = 'name' AND a.ckey = w.ckey AND a.tok = w.tok LEFT JOIN df b ON b.kind = 'addr' AND b.ckey = w.ckey AND b.tok = w.tok),
{', '.join(_sides(k)[0] for k in _KINDS.values())}
SELECT c.rec, c.s1, {', '.join(_overlap(p, k) for p, k in _KINDS.items())} FROM cand c {' '.join(_sides(k)[1] for k in _KINDS.values())}"""

_EQ = lambda c: f"CASE WHEN a.{c} = '' OR b.{c} = '' THEN NULL WHEN a.{c} = b.{c} THEN 1.0 ELSE 0.0 END"
_EQUAL = ["first_tok", "meta_first", "sdx_first", "house", "postal", "unit", "street", "legal", "street_type"]
_ATOMS = ["house", "postal", "street", "street_type", "unit"]
_BOTH_KNOWN = " + ".join(f"CASE WHEN a.{c} <> '' AND b.{c} <> '' THEN 1.0 ELSE 0.0 END" for c in _ATOMS)
_AGREE = " + ".join(f"CASE WHEN a.{c} <> '' AND a.{c} = b.{c} THEN 1.0 ELSE 0.0 END" for c in _ATOMS)
_FREQ = lambda of, c, to: f"ln(1.0 + (SELECT COUNT(*) FROM prepared q WHERE q.source = 1 AND q.ckey = {of}.ckey AND q.{c} = {of}.{c})) AS {to}"
_FLAG_COLUMNS = {
    "core_eq": "CASE WHEN a.core = b.core THEN 1.0 ELSE 0.0 END", "compact_eq": "CASE WHEN a.compact = b.compact THEN 1.0 ELSE 0.0 END", **{f"{c}_eq": _EQ(c) for c in _EQUAL},
    "house_absdiff": "ln(1.0 + abs(TRY_CAST(nullif(a.house, '') AS BIGINT) - TRY_CAST(nullif(b.house, '') AS BIGINT)))",
    "postal_prefix_eq": "CASE WHEN a.postal = '' OR b.postal = '' THEN NULL WHEN substr(a.postal, 1, 3) = substr(b.postal, 1, 3) THEN 1.0 ELSE 0.0 END",
    "postal_lev": "CASE WHEN a.postal = '' OR b.postal = '' THEN NULL ELSE levenshtein(a.postal, b.postal) END",
    "addr_atoms_both": _BOTH_KNOWN, "addr_atoms_agree": _AGREE, "addr_atoms_conflict": f"({_BOTH_KNOWN}) - ({_AGREE})",
    "acronym": "CASE WHEN a.initials = b.compact OR b.initials = a.compact THEN 1.0 ELSE 0.0 END",
    "name_len1": "length(a.core)", "name_len2": "length(b.core)", "name_len_ratio": "CAST(least(length(a.core), length(b.core)) AS DOUBLE) / greatest(length(a.core), length(b.core), 1)",
    "name_ntok1": "len(string_split(a.core, ' '))", "name_ntok2": "len(string_split(b.core, ' '))", "addr_len1": "length(a.addr_n)", "addr_len2": "length(b.addr_n)",
    "s1_name_freq": "a.name_freq", "rec_name_freq": "b.name_freq", "s1_first_freq": "a.first_freq",
}
_FLAGS = f"""{_READY}, {_CAND},
cores AS (SELECT ckey, core, ln(1.0 + COUNT(*)) AS name_freq FROM prepared WHERE source = 1 GROUP BY ckey, core), firsts AS (SELECT ckey, first_tok, ln(1.0 + COUNT(*)) AS first_freq FROM prepared WHERE source = 1 GROUP BY ckey, first_tok),
often AS (SELECT p.*, coalesce(c.name_freq, 0.0) AS name_freq, coalesce(f.first_freq, 0.0) AS first_freq FROM prepared p LEFT JOIN cores c ON c.ckey = p.ckey AND c.core = p.core LEFT JOIN firsts f ON f.ckey = p.ckey AND f.first_tok = p.first_tok)
SELECT c.rec, c.s1, {', '.join(f"round(CAST({v} AS DOUBLE), 5) AS {k}" for k, v in _FLAG_COLUMNS.items())} FROM cand c JOIN often a ON a.id = c.s1 JOIN often b ON b.id = c.rec"""


def _context(col: str) -> str:
    w = f"PARTITION BY rec ORDER BY {col} DESC, s1"
    whole = f"({w} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    return f"CAST(row_number() OVER ({w}) AS DOUBLE) AS {col}_rank_rec, round({col} - CASE WHEN row_number() OVER ({w}) = 1 THEN nth_value({col}, 2) OVER {whole} ELSE max({col}) OVER (PARTITION BY rec) END, 6) AS {col}_gap_rec"


_LINES = f"""WITH {PAIRS}, q AS (SELECT ent, rec, round(p, 6) AS p, label FROM pairs),
folded AS (SELECT o_orderkey AS ent, o_orderkey % 5 AS fold, coalesce(n, 0) AS n_true FROM orders LEFT JOIN (SELECT ent, SUM(label) AS n FROM q GROUP BY ent) ON ent = o_orderkey)"""


def _side(prefix: str, g: str, o: str) -> str:
    w, by = f"PARTITION BY {g}", f"PARTITION BY {g} ORDER BY p DESC, {o}"
    top, second = f"max(p) OVER ({w})", f"nth_value(p, 2) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    best = f"CASE WHEN row_number() OVER ({by}) = 1 THEN {second} ELSE {top} END"
    others = lambda t: f"CAST(count(*) FILTER (p > {t}) OVER ({w}) - CASE WHEN p > {t} THEN 1 ELSE 0 END AS BIGINT)"
    return f"""row_number() OVER ({by}) AS {prefix}_rank, round({best}, 6) AS {prefix}_other, round(p - coalesce({best}, 0), 6) AS {prefix}_gap, round(p / greatest({top}, 0.000001), 6) AS {prefix}_ratio,
  round(CAST(SUM(CAST(p AS DECIMAL(20, 12))) OVER ({w}) - CAST(p AS DECIMAL(20, 12)) AS DOUBLE), 6) AS {prefix}_sum_other, count(*) OVER ({w}) AS {prefix}_n, {others(0.5)} AS {prefix}_c5_other, {others(0.9)} AS {prefix}_c9_other"""


#: Every mode, exclusive or not, at each threshold by itself: the plain way, without the sums of differences.
_EACH = f"""{_LINES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY rec ORDER BY p DESC, ent) AS place FROM q),
kinds AS (SELECT FALSE AS exclusive UNION ALL SELECT TRUE), grid AS (SELECT CAST(round(i * 0.01, 2) AS DOUBLE) AS t FROM range(2, 99) r(i)),
eligible AS (SELECT exclusive, ent, rec, p, label FROM ranked JOIN kinds ON NOT exclusive OR place = 1),
known AS (SELECT *, SUM(CAST(p AS DECIMAL(20, 12))) OVER (PARTITION BY exclusive, ent) AS s, exp(SUM(ln(1 - least(p, 0.9999999))) OVER (PARTITION BY exclusive, ent)) AS nothing,
  SUM(CAST(p AS DECIMAL(20, 12))) OVER w AS c, row_number() OVER w AS k, SUM(label) OVER w AS hits FROM eligible WINDOW w AS (PARTITION BY exclusive, ent ORDER BY p DESC, rec ROWS UNBOUNDED PRECEDING)),
hoped AS (SELECT *, 1.25 * CAST(c AS DOUBLE) / (0.25 * CAST(s AS DOUBLE) + k) AS e FROM known),
tried AS (SELECT exclusive, t, ent, max(nothing) AS nothing, max(e) AS most, max(k) AS n, max(hits) AS tp FROM hoped JOIN grid ON p >= t GROUP BY exclusive, t, ent),
cut AS (SELECT x.exclusive, x.t, x.ent, any_value(x.nothing) AS nothing, any_value(x.most) AS most, min(h.k) AS k FROM tried x JOIN hoped h ON h.exclusive = x.exclusive AND h.ent = x.ent AND h.p >= x.t AND h.e >= x.most - 0.000000000001 GROUP BY x.exclusive, x.t, x.ent),
chosen AS (SELECT 'threshold' AS mode, exclusive, t, ent, n, tp FROM tried UNION ALL SELECT 'expected_f', x.exclusive, x.t, x.ent, x.k, h.hits FROM cut x JOIN hoped h ON h.exclusive = x.exclusive AND h.ent = x.ent AND h.k = x.k WHERE x.most > x.nothing),
modes AS (SELECT DISTINCT mode FROM chosen),
curve AS (SELECT m.mode, kinds.exclusive, grid.t, f.fold, COUNT(*) AS entities, SUM(coalesce(c.n, 0)) AS n_pred, SUM(CASE WHEN c.n IS NULL THEN CASE WHEN f.n_true = 0 THEN 1.0 ELSE 0.0 END WHEN c.tp = 0 THEN 0.0 ELSE 1.25 * c.tp / (0.25 * f.n_true + c.n) END) AS score
  FROM modes m CROSS JOIN kinds CROSS JOIN grid CROSS JOIN folded f LEFT JOIN chosen c ON c.mode = m.mode AND c.exclusive = kinds.exclusive AND c.t = grid.t AND c.ent = f.ent GROUP BY m.mode, kinds.exclusive, grid.t, f.fold)"""

_HASH = lambda key, seed, n=8: f"CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, {n})) AS BIGINT)"
_UNIT = lambda key, seed: f"CAST({_HASH(key, seed)} AS DOUBLE) / 4294967295"
_COUNTS = "counts AS (SELECT e.id AS ent, COUNT(r.id) AS n_true FROM prepared e LEFT JOIN prepared r ON r.owner = e.id WHERE e.source = 1 GROUP BY e.id)"
_STRATA = f"{_READY}, {_COUNTS}, placed AS (SELECT *, least(n_true, 3) AS st, row_number() OVER (PARTITION BY least(n_true, 3) ORDER BY {_HASH('ent', '{seed}', 15)}, ent) AS k, COUNT(*) OVER (PARTITION BY least(n_true, 3)) AS n FROM counts)"

_BARE = f"""{_READY}, shared AS (SELECT {_KEYNAME} || '|' || country AS own, COUNT(*) AS k FROM prepared WHERE source = 1 GROUP BY 1),
bare AS (SELECT r.id, r.owner, s.k, regexp_replace(lower(r.core || r.legal), '[^0-9a-z]', '', 'g') || '|' || r.country = s.own AS same FROM prepared r JOIN prepared e ON e.id = r.owner
  JOIN shared s ON s.own = regexp_replace(lower(e.core || e.legal), '[^0-9a-z]', '', 'g') || '|' || e.country WHERE r.addr_n = ''),
lost AS (SELECT owner, COUNT(*) AS l FROM bare WHERE k > 1 GROUP BY owner), {_COUNTS},
cost AS (SELECT AVG(CASE WHEN l IS NULL THEN 0.0 WHEN n_true - l > 0 THEN 1 - 1.25 * (n_true - l) / (0.25 * n_true + n_true - l) ELSE 1.0 END) AS loss FROM counts LEFT JOIN lost ON owner = ent)"""

_codes = lambda c, width: f"list_transform(range(1, {width + 1}), lambda i: CASE WHEN i > length({c}) THEN 0 WHEN strpos(' abcdefghijklmnopqrstuvwxyz0123456789', substr({c}, i, 1)) = 0 THEN 2 ELSE strpos(' abcdefghijklmnopqrstuvwxyz0123456789', substr({c}, i, 1)) + 2 END)"

SQL = {
    "prepared_records": f"{_READY} SELECT id, ckey, name_n, core, compact, initials, first_tok, meta_first, sdx_first, phon, legal, addr_n, trim(core || ' ' || addr_n) AS \"full\", core AS core_toks, addr_n AS addr_toks, name_nums, addr_nums, house, street, street_type, unit, postal, FALSE AS translit FROM prepared",
    "states": f"{_READY} SELECT id, state FROM prepared",
    "record_keys": f"{_READY}, {_KEYS} SELECT id, key FROM keyed",
    "key_candidates": f"{_READY}, {_CAND} SELECT rec, s1, round(score, 4) AS score, key_rank FROM cand",
    "gram_cosines": f"{_READY}, {_COS} SELECT rec, s1, round(cos_name_c, 5) AS cos_name_c, round(cos_full_c, 5) AS cos_full_c, round(cos_addr_c, 5) AS cos_addr_c FROM cosines",
    "candidate_cap": f"{_READY}, {_CAP} SELECT rec, s1, cheap, cheap_rank, kept FROM capped",
    "pair_overlaps": _OVERLAPS,
    "pair_flags": _FLAGS,
    "pair_context": f"{_READY}, {_CAP} SELECT rec, s1, COUNT(*) OVER (PARTITION BY rec) AS n_cand_rec, {_context('cheap')}, {_context('key_score')} FROM capped",
    "blocking_report": f"""{_READY}, {_SCORED}, found AS (SELECT s1, SUM(label) AS found FROM scored WHERE kept GROUP BY s1), ceiling AS (SELECT n_true, {_F('coalesce(found, 0)', 'n_true', 'coalesce(found, 0)')} AS f FROM counts c LEFT JOIN found ON found.s1 = c.s1),
sums AS (SELECT CAST(SUM(CASE WHEN kept THEN 1 ELSE 0 END) AS BIGINT) AS pairs, COUNT(DISTINCT rec) AS records, SUM(CASE WHEN kept THEN label ELSE 0 END) AS hits, SUM(label) AS before, SUM(CASE WHEN kept AND cheap_rank <= 3 THEN label ELSE 0 END) AS top FROM scored)
SELECT pairs, records, round(pairs / CAST(records AS DOUBLE), 6) AS pairs_per_record, CAST(t AS BIGINT) AS true_pairs, round(hits / CAST(t AS DOUBLE), 6) AS recall, round(before / CAST(t AS DOUBLE), 6) AS recall_before_cap, round(top / CAST(t AS DOUBLE), 6) AS recall_at_cap, round(ca, 6) AS ceiling_all, round(cm, 6) AS ceiling_matched
FROM sums, (SELECT SUM(n_true) AS t, AVG(f) AS ca, AVG(f) FILTER (n_true > 0) AS cm FROM ceiling)""",
    "blocking_misses": f"{_READY}, {_CAP} SELECT r.owner AS s1, r.id AS rec, CASE WHEN c.kept IS NULL THEN 'not_generated' ELSE 'capped' END AS reason FROM prepared r LEFT JOIN capped c ON c.rec = r.id AND c.s1 = r.owner WHERE r.source > 1 AND NOT coalesce(c.kept, FALSE)",
    "entity_gains": f"{_READY}, {_GAINS} SELECT s1, {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in ('n_true', 'tp', 'n_pred', 'n_fp', 'n_fn', 'n_miss'))}, {', '.join(f'round({c}, 5) AS {c}' for c in ('f', 'gain_fp', 'gain_fn', 'gain_miss'))} FROM gains",
    "pair_losses": f"{_READY}, {_LOST} SELECT kind, s1, rec, p, round(pts, 5) AS pts FROM lost",
    "worst_errors": f"{_READY}, {_LOST} SELECT * FROM (SELECT kind, row_number() OVER (PARTITION BY kind ORDER BY round(pts, 5) DESC, s1, rec) AS place, s1, rec, round(pts, 5) AS pts FROM lost) WHERE place <= 15",
    "error_cross_table": f"""{_READY}, {_LOST}, chains AS (SELECT lower({_RAW_NAME}) AS nm FROM prepared WHERE source = 1 GROUP BY 1 HAVING COUNT(*) >= 5),
marks AS (SELECT CASE kind WHEN 'MISS' THEN 'FN_blocking' ELSE kind END AS kind, list_filter([CASE WHEN abs(coalesce(p, -1) - 0.6) < 0.25 THEN 'boundary' END, CASE WHEN length(b.addr_n) < 5 OR length(a.addr_n) < 5 THEN 'sparse:no_address' END,
  CASE WHEN c.n_true = 0 THEN 'edge:singleton' END, CASE WHEN lower(trim(upper(a.core) || CASE WHEN a.legal = '' THEN '' ELSE ' ' || a.legal || '.' END)) IN (SELECT nm FROM chains) THEN 'edge:chain' END], lambda x: x IS NOT NULL) AS l
  FROM lost JOIN prepared a ON a.id = lost.s1 JOIN prepared b ON b.id = lost.rec JOIN counts c ON c.s1 = lost.s1),
each AS (SELECT kind, unnest(CASE WHEN len(l) = 0 THEN ['other'] ELSE l END) AS bucket FROM marks)
SELECT coalesce(bucket, 'All') AS bucket, coalesce(kind, 'All') AS kind, COUNT(*) AS n FROM each GROUP BY CUBE (bucket, kind)""",
    "country_summary": f"""{_READY}, {_SCORED}, per AS (SELECT s1, SUM(CASE WHEN taken THEN 1 ELSE 0 END) AS np, COUNT(*) AS nc, max(p) AS top FROM scored WHERE kept GROUP BY s1)
SELECT country, COUNT(*) AS entities, round(AVG(coalesce(np, 0)), 5) AS mean_matches, round(AVG(CASE WHEN coalesce(np, 0) = 0 THEN 1.0 ELSE 0.0 END), 5) AS empty_rate, round(AVG(coalesce(nc, 0)), 5) AS mean_candidates, round(AVG(coalesce(top, 0)), 5) AS mean_top_p FROM prepared e LEFT JOIN per ON per.s1 = e.id WHERE e.source = 1 GROUP BY country""",
    "record_profile": f"WITH {BOTH}, raw AS ({RAW}) SELECT country, CAST(source AS BIGINT) AS source, COUNT(*) AS rows, round(AVG(CASE WHEN address = '' THEN 1.0 ELSE 0.0 END), 6) AS empty_address, 0.0::DOUBLE AS null_in_address, 0.0::DOUBLE AS native_name, 0.0::DOUBLE AS other_name, median(length(name)) AS name_length, median(length(address)) AS address_length FROM raw GROUP BY country, source",
    "pair_codes": f"""WITH {BOTH}, said AS (SELECT id, owner, trim(lower(name)) AS n, lower(address) AS a FROM ({RAW})),
bare AS (SELECT id, owner, trim(replace(n, '.', '')) AS n, replace(a, ',', '') AS a FROM said),
coded AS (SELECT id, owner, list_concat({_codes('n', 24)}, {_codes('a', 32)}) AS c FROM bare)
SELECT e.id AS s1, r.id AS rec, array_to_string(list_concat([1], e.c, r.c), ' ') AS codes FROM coded r JOIN coded e ON e.id = r.owner""",
    "truth_statistics": f"{_READY}, {_COUNTS} SELECT least(n_true, 10) AS n_matches, COUNT(*) AS entities, round(COUNT(*) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 6) AS share, round((SELECT AVG(n_true) FROM counts), 6) AS mean, (SELECT max(n_true) FROM counts) AS greatest FROM counts GROUP BY 1",
    "truth_violations": f"{_READY} SELECT CAST(0 AS BIGINT) AS owned_twice, COUNT(*) AS owned, CAST(SUM(CASE WHEN e.ckey <> r.ckey THEN 1 ELSE 0 END) AS BIGINT) AS cross_country, COUNT(*) AS pairs FROM prepared r JOIN prepared e ON e.id = r.owner",
    "upper_bound": f"{_BARE} SELECT COUNT(*) AS records, COUNT(*) FILTER (k > 1) AS ambiguous, COUNT(*) FILTER (same) AS exact, round(any_value(loss), 6) AS loss, round(1 - any_value(loss), 6) AS best FROM bare, cost",
    "record_owners": f"{_READY} SELECT id, owner FROM prepared WHERE source > 1",
    "orphan_countries": f"{_READY} SELECT ckey, COUNT(*) AS records FROM prepared WHERE source > 1 AND ckey NOT IN (SELECT ckey FROM sizes) GROUP BY ckey",
    "country_subset": f"{_READY} SELECT CASE WHEN source = 1 THEN 'entity' ELSE 'record' END AS kind, id FROM prepared WHERE ckey IN ('us', 'canada') UNION ALL SELECT 'truth', r.id FROM prepared r JOIN prepared e ON e.id = r.owner WHERE e.ckey IN ('us', 'canada')",
    "state_subset": f"""{_READY}, inside AS (SELECT DISTINCT state FROM prepared WHERE source = 1 AND state <> '' AND {_UNIT('state', '7')} < 0.6),
ents AS (SELECT id FROM prepared WHERE source = 1 AND (state = '' OR state IN (SELECT state FROM inside))),
recs AS (SELECT id, owner FROM prepared WHERE source > 1 AND owner IN (SELECT id FROM ents) AND (state = '' OR state IN (SELECT state FROM inside)))
SELECT 'entity' AS kind, id FROM ents UNION ALL SELECT 'record', id FROM recs UNION ALL SELECT 'truth', id FROM recs""",
    "thinned_entities": f"{_READY}, {_COUNTS} SELECT ent AS id, n_true AS records FROM counts WHERE {_UNIT('ent', 'thin')} >= 0.2",
    "sampled_entities": _STRATA.replace("{seed}", "sample") + " SELECT ent, n_true FROM placed WHERE k <= round_even(n * greatest(1, (SELECT COUNT(*) FROM counts) // 3) / CAST((SELECT COUNT(*) FROM counts) AS DOUBLE), 0)",
    "entity_folds": _STRATA.replace("{seed}", "fold") + f", least AS (SELECT min(n) AS m FROM placed), whole AS (SELECT ent, row_number() OVER (ORDER BY {_HASH('ent', 'fold', 15)}, ent) AS k FROM counts) SELECT p.ent, CASE WHEN m >= 5 THEN (p.k - 1) % 5 ELSE (w.k - 1) % 5 END AS fold FROM placed p JOIN whole w ON w.ent = p.ent, least",
    "stratified_sample": f"SELECT o_orderkey, o_orderpriority FROM (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_HASH('o_orderkey', 's', 15)}, o_orderkey) AS k, COUNT(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) WHERE k * 10 <= n",
    "decision_curve": f"{_EACH} SELECT mode, exclusive, t AS threshold, round(SUM(score) / SUM(entities), 5) AS macro_f05, CAST(SUM(n_pred) AS BIGINT) AS n_pred FROM curve GROUP BY mode, exclusive, t",
    "nested_evaluation": f"""{_EACH}, size AS (SELECT COUNT(*) AS n FROM folded), own AS (SELECT fold, COUNT(*) AS m FROM folded GROUP BY fold),
coarse AS (SELECT c.*, row_number() OVER (ORDER BY t) AS i FROM (SELECT DISTINCT t FROM grid) c),
tuned AS (SELECT o.fold, c.mode, c.t, (SUM(c.score) + any_value(o.m)) / any_value(n) AS f FROM curve c JOIN own o ON c.fold <> o.fold CROSS JOIN size JOIN coarse g ON g.t = c.t AND g.i % 2 = 1 WHERE NOT c.exclusive GROUP BY o.fold, c.mode, c.t),
top AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY f DESC, mode DESC, t) AS r FROM tuned),
flat AS (SELECT t.fold, t.mode, t.t, median(t.t) OVER (PARTITION BY t.fold) AS mid FROM tuned t JOIN top b ON b.r = 1 AND b.fold = t.fold AND b.mode = t.mode AND t.f >= b.f - 0.0005),
near AS (SELECT t.fold, t.mode, t.t, row_number() OVER (PARTITION BY t.fold ORDER BY abs(t.t - x.mid), t.t) AS r FROM tuned t JOIN (SELECT DISTINCT fold, mode, mid FROM flat) x ON x.fold = t.fold AND x.mode = t.mode),
done AS (SELECT n.fold, n.mode, n.t AS threshold, c.score / c.entities AS f, c.entities FROM near n JOIN curve c ON NOT c.exclusive AND c.fold = n.fold AND c.mode = n.mode AND c.t = n.t WHERE n.r = 1)
SELECT fold, mode, threshold, round(f, 6) AS macro_f05, entities FROM done UNION ALL SELECT NULL, NULL, NULL, round(SUM(f * entities) / SUM(entities), 6), CAST(SUM(entities) AS BIGINT) FROM done""",
    "exclusive_selection": f"""{_EACH}, best AS (SELECT * FROM tried WHERE exclusive AND t = 0.3), stop AS (SELECT c.ent, CASE WHEN most > nothing THEN k ELSE 0 END AS k FROM cut c WHERE exclusive AND t = 0.3)
SELECT 'threshold' AS mode, ent, rec, p FROM eligible WHERE exclusive AND p >= 0.3 UNION ALL SELECT 'expected_f', h.ent, h.rec, h.p FROM hoped h JOIN stop ON stop.ent = h.ent AND h.k <= stop.k WHERE h.exclusive AND h.p >= 0.3""",
    "stage_two_frame": f"{_LINES} SELECT rec, ent AS s1, round(p, 6) AS p1, round(ln(least(greatest(p, 0.000001), 0.999999) / (1 - least(greatest(p, 0.000001), 0.999999))), 6) AS p1_logit, {_side('rec', 'rec', 'ent')}, {_side('ent', 'ent', 'rec')} FROM q",
    "judge_features": f"""{_LINES}, j AS (SELECT *, ln(p / (1 - least(p, 0.999999))) AS logit FROM q WHERE p >= 0.4), c AS (SELECT *, 1 / (1 + exp(-logit)) AS pc FROM j),
w AS (SELECT *, row_number() OVER (PARTITION BY rec ORDER BY pc DESC, ent) AS rr, max(pc) OVER (PARTITION BY rec) AS rt, row_number() OVER (PARTITION BY ent ORDER BY pc DESC, rec) AS er, max(pc) OVER (PARTITION BY ent) AS et FROM c),
v AS (SELECT *, max(CASE WHEN rr = 2 THEN pc END) OVER (PARTITION BY rec) AS r2, max(CASE WHEN er = 2 THEN pc END) OVER (PARTITION BY ent) AS e2 FROM w)
SELECT q.rec, q.ent AS s1, round(logit, 6) AS ce_logit, rr AS ce_rec_rank, round(pc - coalesce(CASE WHEN rr = 1 THEN r2 ELSE rt END, 0), 6) AS ce_rec_gap, er AS ce_ent_rank, round(pc - coalesce(CASE WHEN er = 1 THEN e2 ELSE et END, 0), 6) AS ce_ent_gap, round(sqrt(pc * v.p), 6) AS ce_x_p1 FROM q LEFT JOIN v ON v.rec = q.rec AND v.ent = q.ent""",
    "training_pairs": f"{_LINES} SELECT ent, rec FROM q WHERE label = 1 OR p >= 0.6 OR {_UNIT("ent || '|' || rec", 'easy')} < 0.05",
    "touching_pairs": f"{_LINES} SELECT ent, rec FROM q WHERE rec IN (SELECT rec FROM q JOIN folded f ON f.ent = q.ent WHERE n_true > 2)",
    "feature_importance": "SELECT event_type AS feature, round(CAST(AVG(CAST(value AS DECIMAL(20, 6))) AS DOUBLE), 4) AS gain, round(100 * AVG(value) / SUM(AVG(value)) OVER (), 4) AS gain_pct FROM events GROUP BY event_type",
    "list_violations": f"""{_READY}, {_SCORED}, good AS (SELECT s1, rec FROM scored WHERE taken), hit AS (SELECT DISTINCT s1 FROM good), times AS (SELECT s1, CASE WHEN s1 LIKE '%7' THEN 2 ELSE 1 END AS n, s1 LIKE '%3' AS bad FROM hit)
SELECT 'repeated entity' AS violation, COUNT(*) AS n, min(s1) AS example FROM times WHERE n = 2
UNION ALL SELECT 'missing entity', COUNT(*), min(id) FROM prepared WHERE source = 1 AND id NOT IN (SELECT s1 FROM hit) UNION ALL SELECT 'unknown entity', CAST(0 AS BIGINT), NULL
UNION ALL SELECT 'repeated id', COUNT(*), min(rec) FROM good WHERE s1 LIKE '%7' UNION ALL SELECT 'wrong kind of id', CAST(SUM(n) AS BIGINT), CASE WHEN COUNT(*) > 0 THEN 'S1-1' END FROM times WHERE bad
UNION ALL SELECT 'unknown id', CAST(2 * SUM(n) AS BIGINT), CASE WHEN COUNT(*) > 0 THEN 'S1-1' END FROM times WHERE bad UNION ALL SELECT 'no candidate', CAST(2 * SUM(n) AS BIGINT), CASE WHEN COUNT(*) > 0 THEN 'S1-1' END FROM times WHERE bad""",
}
