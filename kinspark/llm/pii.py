"""Surrogates for personal data, by DataFrame functions alone.

Detected: e-mail addresses, IPv4 addresses, payment cards (with a valid check digit), social security numbers, telephone
numbers and names: the whole run of words and initials after a form of address, and the same words wherever they stand
capitalised in that document. Each distinct value (in a canonical form: lower case, digits without
separators) gets one surrogate, derived from a secret key by SHA-256, that keeps its type, length, script, letter classes
and, for names, the last letter that carries the gender; cards stay valid and keep their
first digit, as international telephone numbers do; addresses keep their top-level domain. A
surrogate that two values share, or that is itself a value of the corpus, is derived anew until none is left: distinct
values stay distinct, equal ones stay equal, in every document. Occurrences keep their case and separators. A value that
finds no surrogate of its own length in ATTEMPTS derivations gets longer ones (letters behind the first, digits at the
end, for cards before the check digit, a further octet), by one with each derivation, so every value finds one.
Initials become other initials of their script, one to one under the key; as letters are few, such a letter can be another
one's initial.

The gender of a name is that of its last letter, which stays; forms of address stay too. A telephone number with and without
its country code counts as two values. After one form of address, name words of up to 250 letters can follow each other.

Defined cases: null texts stay null; texts of any length are searched whole; of df's columns only keep and the text are read; texts without findings stay as they are; repeated rows and null doc_ids are rows of
their own; values that only look like cards stay.
"""

from __future__ import annotations

import functools
import hashlib
import sys
import unicodedata

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

# Forms of address that a name follows.
ADDRESS = "Mr|Mrs|Ms|Miss|Mister|Dr|Prof|Herr|Frau|Monsieur|Madame|Mademoiselle|Mme|Mlle|Señor|Señora|Señorita|Sr|Sra|Don|Doña|Г-н|Г-жа|Господин|Госпожа|Κύριος|Κυρία"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# a name word of any length, without a possessive's end, and an initial
_APOSTROPHE = r"['’](?!s?(?![\p{L}\p{M}]))"
_NAME = rf"\p{{Lu}}(?:{_APOSTROPHE})?[\p{{L}}\p{{M}}\-]++(?:{_APOSTROPHE}[\p{{L}}\p{{M}}\-]++){{0,9}}"
_INITIAL = r"\p{Lu}(?![\p{L}\p{M}\p{N}'’\-])"
#: Pattern of each type; the first that matches at a place holds.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@(?:[\p{L}\p{N}\-]++\.){1,126}\p{L}{2,63}",
    "ip": rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.\d)",
    "ssn": r"(?<![\p{L}\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)",
    "card": r"(?<![\p{L}\p{N}.+\-])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3}|\d{4}[ \-]\d{6}[ \-]\d{5})(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}.+])(?:\+\d{1,3}[ .\-]?\(\d{1,4}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}|\+\d{1,3}(?:[ .\-]?\d{2,7}){2,4}|\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4})(?![\p{L}\p{N}])",
    # after a form of address, or right after a name word or initial found before (\G)
    "name": rf"(?=\p{{Lu}})(?:(?<=(?<![\p{{L}}\p{{N}}])(?:{ADDRESS})\.? )|(?<=\G )(?<=(?<![\p{{L}}\p{{N}}.@_%+\-])\p{{Lu}}[\p{{L}}\p{{M}}'’\-]{{0,250}} )|(?<=\G\. ?)(?<=(?<![\p{{L}}\p{{N}}@_%+\-])\p{{Lu}}\. ?))(?:{_NAME}|{_INITIAL})",
}
FOUND = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Words that may be a document's names again, and initials.
AGAIN = rf"(?<![\p{{L}}\p{{M}}\p{{N}}])(?:{_NAME}|\p{{Lu}}(?=\.))"
#: Without a sign of this, a text holds nothing that the patterns find.
HINT = rf"[0-9@]|(?=[{''.join(sorted({x[0] for x in ADDRESS.split('|')}))}])(?:{ADDRESS})\.? \p{{Lu}}"
# Letters by script and class; a letter's surrogate comes from its own class. Signs outside these: see _runs.
LETTERS = (
    "aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùâêîôûäëïöüãõåæøœ", "ñçšžčřćńśźżłđğş", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ",
    "אבגדהוזחטיכלמנסעפצקרשת", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "कखगघचछजझटठडढतथदधनपफबभमयरलवशषसह",
)
DIGITS = ("ssn", "card", "phone")
#: Derivations of one value at its own length before its surrogates grow.
ATTEMPTS = 50
#: Signs below which a run is too narrow to draw surrogates from.
NARROW = 8


def _luhn(digits: str) -> str:
    """SQL: does a string of digits carry a valid check digit?"""
    return f"aggregate(transform(split(reverse({digits}), ''), (c, i) -> CASE WHEN i % 2 = 0 THEN int(c) ELSE int(c) * 2 - CASE WHEN int(c) > 4 THEN 9 ELSE 0 END END), 0, (a, b) -> a + b) % 10 = 0"


def _kind(e: str) -> str:
    """SQL: type of a finding, null for what only looks like one."""
    q = {k: p.replace("\\", "\\\\").replace("'", "\\'") for k, p in PATTERNS.items()}
    return f"""CASE WHEN {e} LIKE '%@%' THEN 'email'
      WHEN length({e}) = 1 THEN 'initial'
      WHEN NOT {e} RLIKE '[0-9]' THEN 'name'
      WHEN {e} RLIKE '^{q["ip"]}$' THEN 'ip'
      WHEN {e} RLIKE '^{q["ssn"]}$' THEN 'ssn'
      WHEN {e} RLIKE '^{q["card"]}$' THEN CASE WHEN {_luhn(f"regexp_replace({e}, '[^0-9]', '')")} THEN 'card' END
      ELSE 'phone' END"""


def _canon() -> str:
    return "CASE WHEN kind IN ('ssn', 'card', 'phone') THEN concat(CASE WHEN found LIKE '+%' THEN '+' ELSE '' END, regexp_replace(found, '[^0-9]', '')) WHEN kind = 'ip' THEN found ELSE lower(found) END"


def _random(i: str) -> str:
    """SQL: a number below 2^32 from the key, the value, the attempt and a place."""
    return f"CAST(conv(substring(sha2(concat_ws('|', secret, kind, canon, attempt, {i}), 256), 1, 8), 16, 10) AS BIGINT)"


@functools.cache
def _runs() -> str:
    """SQL: runs of neighbouring letters and figures (s to e) of one script and class that a small letter can be found in, and where
    their surrogates come from (n code points from f): the run itself, or a wider one of the script, or a to z."""
    runs, key = [], None
    for x in range(128, sys.maxunicode + 1):
        c = chr(x)
        kind = unicodedata.category(c)
        if kind[0] not in "LN" or c.lower() != c:
            key = None
            continue
        # small letters that are not what their capital's small letter is (or have no one capital) would not come back
        good = kind != "Ll" or len(c.upper()) == 1 and c.upper() != c and c.upper().lower() == c
        now = (unicodedata.name(c, "").split("-")[0].split(" ")[0], kind, good)
        if now == key:
            runs[-1][1] = x
        else:
            runs.append([x, x, now])
        key = now
    wide: dict[tuple, tuple] = {}
    for s, e, k in runs:
        if k[2] and e - s >= wide.get(k[:2], (0, NARROW - 1))[1] - 1:
            wide[k[:2]] = (s, e - s + 1)
    rows = [(s, e, *((s, e - s + 1) if k[2] and e - s + 1 >= NARROW else wide.get(k[:2], (97, 26)))) for s, e, k in runs]
    column = lambda j: f"array({', '.join(str(r[j]) for r in rows)})"
    return f"transform(arrays_zip({', '.join(column(j) for j in range(4))}), r -> named_struct('s', r.`0`, 'e', r.`1`, 'f', r.`2`, 'n', r.`3`))"


def _derived() -> str:
    """SQL: the surrogate's canonical form, derived from base: canon, or canon made longer."""
    pick = lambda alphabet, i: f"substring('{alphabet}', CAST({_random(i)} % {len(alphabet)} AS INT) + 1, 1)"
    letter = " ".join(f"WHEN instr('{a}', c) > 0 THEN {pick(a, 'i')}" for a in LETTERS)
    other = f"coalesce(get(transform(filter(runs, r -> ascii(c) BETWEEN r.s AND r.e), r -> decode(unhex(lpad(hex(r.f + {_random('i')} % r.n), 8, '0')), 'UTF-32')), 0), c)"
    kept = "(kind = 'email' AND i >= length(base) - instr(reverse(base), '.')) OR (kind = 'name' AND i > 1 AND i = length(base) - 1)"
    words = f"array_join(transform(split(base, ''), (c, i) -> CASE WHEN {kept} THEN c WHEN c RLIKE '[0-9]' THEN {pick('0123456789', 'i')} {letter} WHEN c RLIKE '[^\\\\x00-\\\\x7f]' THEN {other} ELSE c END), '')"
    digits = f"array_join(transform(split(base, ''), (c, i) -> CASE WHEN c = '+' OR i = 0 AND (kind = 'card' OR c = '0') OR i = 1 AND base LIKE '+%' THEN c WHEN i = 0 THEN {pick('123456789', 'i')} ELSE {pick('0123456789', 'i')} END), '')"
    octets = f"array_join(transform(split(base, '[.]'), (c, i) -> CAST(CASE WHEN i = 0 THEN 1 + {_random('i')} % 223 ELSE {_random('i')} % 256 END AS STRING)), '.')"
    body = f"transform(array(substring({digits}, 1, length(base) - 1)), d -> concat(d, CAST((10 - aggregate(transform(split(reverse(d), ''), (c, i) -> CASE WHEN i % 2 = 1 THEN int(c) ELSE int(c) * 2 - CASE WHEN int(c) > 4 THEN 9 ELSE 0 END END), 0, (a, b) -> a + b) % 10) % 10 AS STRING)))[0]"
    return f"CASE WHEN kind = 'card' THEN {body} WHEN kind IN ('ssn', 'phone') THEN {digits} WHEN kind = 'ip' THEN {octets} ELSE {words} END"


def _base(more: int) -> str:
    """SQL: canon, longer by so many places."""
    like = "coalesce(nullif(regexp_extract(canon, '[a-z]', 0), ''), nullif(regexp_extract(canon, '\\\\p{L}', 0), ''), 'b')"
    return f"CASE WHEN kind IN ('ssn', 'card', 'phone') THEN concat(canon, repeat('1', {more})) WHEN kind = 'ip' THEN concat(canon, repeat('.1', {more})) ELSE concat(left(canon, 1), repeat({like}, {more}), substring(canon, 2)) END"


def _cased(found: str, canon: str, surrogate: str) -> str:
    """SQL: the surrogate of letters with an occurrence's case."""
    more = f"(length({surrogate}) - length({canon}))"
    at = f"{surrogate}, i + 1 + CASE WHEN i = 0 THEN 0 ELSE {more} END, 1"
    grown = f"substring({surrogate}, 2, {more})"
    return f"array_join(transform(split({found}, ''), (c, i) -> CASE WHEN c != lower(c) THEN upper(substring({at})) ELSE substring({at}) END || CASE WHEN i > 0 THEN '' WHEN {found} = upper({found}) THEN upper({grown}) ELSE {grown} END), '')"


def _initials(secret: str) -> tuple[str, str]:
    """Capitals and what each becomes as an initial: the next one of its script in an order drawn from the key, so none two the same."""
    groups: dict[tuple, list[str]] = {}
    for x in range(sys.maxunicode + 1):
        if unicodedata.category(chr(x)) == "Lu":
            groups.setdefault((unicodedata.name(chr(x), "").split(" ")[0], x < 128), []).append(chr(x))
    rows = [sorted(g, key=lambda c: hashlib.sha256(f"{secret}|initial|{c}".encode()).digest()) for g in groups.values()]
    return "".join(c for g in rows for c in g), "".join(c for g in rows for c in g[1:] + g[:1])


def _recurring() -> str:
    """SQL: a piece x of a text, the document's names (_names) in it replaced, and how often."""
    q = AGAIN.replace("\\", "\\\\").replace("'", "\\'")
    by = f"CASE WHEN _names[lower(w)] IS NULL THEN w WHEN length(w) = 1 THEN upper(_names[lower(w)]) ELSE {_cased('w', 'lower(w)', '_names[lower(w)]')} END"
    text = f"concat(z.s[0], array_join(transform(z.w, (w, j) -> concat({by}, z.s[j + 1])), ''))"
    return f"transform(array(named_struct('s', split(x, '{q}', -1), 'w', regexp_extract_all(x, '{q}', 0))), z -> named_struct('t', {text}, 'n', size(filter(z.w, w -> _names[lower(w)] IS NOT NULL))))[0]"


def _laid_out() -> str:
    """SQL: the surrogate with an occurrence's case and separators; what it is longer by follows the first letter or the last digit."""
    figures = "regexp_replace(surrogate, '[^0-9]', '')"
    digits = f"concat(array_join(transform(split(found, ''), (c, i) -> CASE WHEN c RLIKE '[0-9]' THEN substring({figures}, length(regexp_replace(left(found, i + 1), '[^0-9]', '')), 1) ELSE c END), ''), substring({figures}, length(regexp_replace(found, '[^0-9]', '')) + 1))"
    whole = "CASE WHEN kind = 'name' THEN concat(upper(left(surrogate, 1)), substring(surrogate, 2)) ELSE surrogate END"
    return f"CASE WHEN kind = 'ip' THEN surrogate WHEN kind IN ('email', 'name') AND length(found) != length(canon) THEN {whole} WHEN kind IN ('email', 'name') THEN {_cased('found', 'canon', 'surrogate')} ELSE {digits} END"


def surrogates(values: DataFrame, secret: str) -> DataFrame:
    """kind, canon and surrogate of each distinct value: no two alike, none a value itself."""
    values = materialise(values.distinct(), "pii-values")
    # a digest of the key, from a table of one row: plans and event logs show its name alone
    key = values.sparkSession.createDataFrame([(hashlib.sha256(f"surrogates|{secret}".encode()).hexdigest(),)], "secret string")
    todo, done, attempt = values, None, 0
    while True:
        made = todo.withColumns({"secret": key.scalar(), "attempt": F.lit(attempt), "base": F.expr(_base(max(0, attempt - ATTEMPTS + 1))), "runs": F.expr(_runs())})
        made = made.withColumn("surrogate", F.expr(_derived())).select("kind", "canon", "surrogate")
        known = values.select("kind", F.col("canon").alias("surrogate"), F.lit(True).alias("_real"))
        taken = made.withColumn("_new", F.lit(1))
        taken = taken if done is None else taken.unionByName(done.withColumn("_new", F.lit(0)))
        first = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("_new", "canon"))
        judged = materialise(taken.withColumn("_n", first).join(known, ["kind", "surrogate"], "left"), "pii-round")
        free = (F.col("_n") == 1) & F.col("_real").isNull()
        done = judged.filter(free).select("kind", "canon", "surrogate")
        todo = judged.filter(~free).select("kind", "canon")
        if not todo.head(1):
            return done
        attempt += 1


def replace_documents(df: DataFrame, secret: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, the text with surrogates and n_replaced of each row."""
    keys = [f"k{i}" for i in range(len(keep))]  # other names meanwhile: theirs may be ours
    docs = df.select(*[F.col(c).alias(k) for c, k in zip(keep, keys)], F.col(text_col).alias("_t"))
    hinted = F.coalesce(F.col("_t").rlike(HINT), F.lit(False))
    some = docs.filter(hinted).withColumn("_x", F.xxhash64("_t")).withColumn("_y", F.octet_length("_t"))
    found = F.regexp_extract_all("_t", F.lit(FOUND), F.lit(0))
    hits = some.select("_x", "_y", found.alias("_f"))
    # one row for each finding of each distinct text
    each = hits.select("_x", "_y", F.posexplode_outer("_f").alias("_i", "found")).filter("found is not null").distinct()
    each = each.withColumn("kind", F.expr(_kind("found"))).filter("kind is not null").withColumn("canon", F.expr(_canon()))
    each = materialise(each, "pii-found")
    table = surrogates(each.filter("kind != 'initial'").select("kind", "canon"), secret)
    initial = F.translate("found", *_initials(secret))
    laid = each.join(table, ["kind", "canon"], "left").withColumn("by", F.when(F.col("kind") == "initial", initial).otherwise(F.expr(_laid_out())))
    named = F.when(F.col("kind") == "initial", F.struct("canon", F.lower("by").alias("surrogate"))).when(F.col("kind") == "name", F.struct("canon", "surrogate"))
    laid = laid.select("_x", "_y", F.struct("_i", "by").alias("_s"), named.alias("_m")).groupBy("_x", "_y").agg(F.collect_list("_s").alias("_s"), F.collect_set("_m").alias("_m"))
    laid = materialise(laid.select("_x", "_y", F.map_from_entries("_s").alias("_by"), F.map_from_entries("_m").alias("_names")), "pii-laid")
    # texts without a hint pass by; the others meet their replacements
    out = some.join(laid, ["_x", "_y"], "left")
    parts = F.split("_t", FOUND, -1)
    again = F.regexp_extract_all("_t", F.lit(FOUND), F.lit(0))
    text = F.expr("concat(_q[0].t, array_join(transform(_e, (e, i) -> concat(coalesce(_by[i], e), _q[i + 1].t)), ''))")
    count = F.expr("CAST(size(_by) + aggregate(_q, 0, (a, q) -> a + q.n) AS BIGINT)")
    # between the findings, the document's names may stand without a form of address
    pieces = F.expr(f"transform(_p, x -> CASE WHEN size(_names) > 0 THEN {_recurring()} ELSE named_struct('t', x, 'n', 0) END)")
    changed = F.when(F.col("_by").isNull(), F.struct(F.lit(None).cast("array<string>").alias("_p"), F.lit(None).cast("array<string>").alias("_e"))).otherwise(F.struct(parts.alias("_p"), again.alias("_e")))
    out = out.withColumn("_c", changed).select(*keys, "_t", "_by", "_names", F.col("_c._p").alias("_p"), F.col("_c._e").alias("_e")).withColumn("_q", pieces)
    out = out.select(*keys, F.when(F.col("_by").isNull(), F.col("_t")).otherwise(text).alias("text"), F.when(F.col("_by").isNull(), 0).otherwise(count).cast("long").alias("n_replaced"))
    return docs.filter(~hinted).select(*keys, F.col("_t").alias("text"), F.lit(0).cast("long").alias("n_replaced")).unionByName(out).toDF(*keep, "text", "n_replaced")
