"""Secret scans: an Aho-Corasick keyword prefilter, anchored regular expressions only near its hits, then checksums.

Base kinds are assign, access and hex; the method adds github (a token whose last six characters are the base-62 CRC-32
of the thirty before), npm (the same layout) and key (a PEM private key block). Spans are code points, end exclusive.
Defined cases: null and empty texts have no spans; a match that fails its length test still consumes its characters, as
leftmost non-overlapping matching does; equal rows give equal results; texts of any length are scanned whole; columns kept go
under other names meanwhile, so theirs cannot clash.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, frugal

KINDS = ("assign", "access", "hex", "github", "npm", "key")
_BASE = KINDS[:3]
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]+")
_GITHUB = re.compile(rb"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_NPM = re.compile(rb"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_PEM = re.compile(rb"-----BEGIN ([A-Z ]*)PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END \1PRIVATE KEY-----")
#: Keyword (lower case) and the kind of regular expression that is tried where it begins.
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign", "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm", "-----begin ": "key"}
_IS_HEX = bytes(120 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
_RUN = b"x" * 16
_BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase


def base62_crc(body: bytes) -> bytes:
    n, out = zlib.crc32(body), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = _BASE62[r] + out
    return out.encode()


def _checked(m: re.Match) -> bool:
    return base62_crc(m[1]) == m[2]


#: Regular expression and validation of each kind found by keyword.
_RULES = {
    "assign": (_ASSIGN, lambda m: len(m[2]) >= 12),
    "access": (_ACCESS, lambda m: len(m[0]) >= 18),
    "github": (_GITHUB, _checked),
    "npm": (_NPM, _checked),
    "key": (_PEM, lambda m: True),
}
_automaton = None


def automaton():
    global _automaton
    if _automaton is None:
        import ahocorasick

        a = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            a.add_word(word, (len(word), kind))
        a.make_automaton()
        _automaton = a
    return _automaton


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed."""
    if not text:
        return []
    raw = text.encode()
    found, hits = [], {}
    for last, (n, kind) in automaton().iter(raw.lower().decode("latin-1")):
        hits.setdefault(kind, []).append(last + 1 - n)
    for kind, starts in hits.items():
        pattern, valid = _RULES[kind]
        free = 0
        for at in sorted(starts):
            if at >= free and (m := pattern.match(raw, at)):
                free = m.end()
                if valid(m):
                    found.append((at, KINDS.index(kind), m.end()))
    mask = raw.translate(_IS_HEX)
    at = mask.find(_RUN)
    while at >= 0:
        end = _HEX.match(raw, at).end()
        found.append((at, KINDS.index("hex"), end))
        at = mask.find(_RUN, end)
    if not found:
        return []
    found.sort()
    if len(raw) == len(text):
        return [(KINDS[k], a, b) for a, k, b in found]
    chars, done, count = {}, 0, 0
    for p in sorted({x for a, _, b in found for x in (a, b)}):  # code points before each end of a span
        count += len(raw[done:p].decode())
        done = p
        chars[p] = count
    return [(KINDS[k], chars[a], chars[b]) for a, k, b in found]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each span, or union of overlapping spans, replaced by [kind]."""
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, a, b = spans[i]
        while i + 1 < len(spans) and spans[i + 1][1] < b:
            i += 1
            b = max(b, spans[i][2])
        out += [text[at:a], f"[{kind}]"]
        at, i = b, i + 1
    return "".join([*out, text[at:]])


def scan_documents(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, n_assign, n_access, n_hex, base_sha256, spans and redacted (null where nothing was found) of each row."""
    arrow_limits(df.sparkSession)
    src = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keep)], F.col(text_col).alias("t"))
    schema = src.drop("t").withColumns({**{f"n_{k}": F.lit(0).cast("long") for k in _BASE}, "base_sha256": F.lit(""), "spans": F.lit(""), "redacted": F.lit("")}).schema
    for f in schema.fields:
        f.nullable = True

    def run(batches):
        for batch in batches:
            texts = batch.column("t").to_pylist()
            spans = [scan(t) for t in texts]
            cols = batch.columns[: len(keep)]
            cols += [pa.array([sum(x[0] == k for x in s) for s in spans], pa.int64()) for k in _BASE]
            cols.append(pa.array([hashlib.sha256(joined([x for x in s if x[0] in _BASE]).encode()).hexdigest() for s in spans], pa.string()))
            cols.append(pa.array(map(joined, spans), pa.string()))
            cols.append(pa.array([redact(t, s) if s else None for t, s in zip(texts, spans, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=schema.fieldNames())

    return src.mapInArrow(frugal(run), schema).toDF(*keep, *schema.fieldNames()[len(keep) :])


def redact_documents(df: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """All rows and columns, the text redacted and, where it is, the count of its characters renewed."""
    arrow_limits(df.sparkSession)
    names = df.columns
    src = df.toDF(*[f"c{i}" for i in range(len(names))])
    schema = src.schema
    for f in schema.fields:
        f.nullable = True
    at, chars = names.index(text_col), names.index(chars_col) if chars_col in names else None

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            new = [redact(t, scan(t)) for t in texts]
            cols = list(batch.columns)
            cols[at] = pa.array(new, cols[at].type)
            if chars is not None:
                old = batch.column(chars).to_pylist()
                cols[chars] = pa.array([n if a is b or a == b else len(b) for a, b, n in zip(texts, new, old, strict=True)], cols[chars].type)
            yield pa.RecordBatch.from_arrays(cols, names=schema.fieldNames())

    return src.mapInArrow(frugal(run), schema).toDF(*names)
