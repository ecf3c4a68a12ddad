"""Preparation of records: names without legal forms, addresses by their parts. Texts are cleaned and phonetic keys made by
column expressions; the rules on words in between are one Arrow function."""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from . import fixed, text

_NUMBER = re.compile(r"\d+[a-z]?")
_BOX = re.compile(r"(?:^|(?<= ))(?:po|p o) box(?: \d+)?(?= |$) ?")
_SOUNDS = re.compile("|".join(a for a, _ in fixed.INDIA_SPELLINGS))
_ANAGRAMS = {tuple(sorted(w)) for w in fixed.LEGAL_ANAGRAMS}


def is_number(word: str) -> bool:
    return _NUMBER.fullmatch(word) is not None


@functools.lru_cache(1 << 18)
def within(a: str, b: str, most: int) -> bool:
    """Are a and b at most so many edits (one a swap of neighbours) apart? Common ends need none; then the first differing
    letters are edited in each way."""
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if abs(len(a) - len(b)) > most:
        return False
    if not a or not b or most == 0:
        return len(a) + len(b) <= most
    swapped = a[:2] == b[1::-1] and len(a) > 1 and len(b) > 1
    return within(a[1:], b[1:], most - 1) or within(a[1:], b, most - 1) or within(a, b[1:], most - 1) or swapped and within(a[2:], b[2:], most - 1)


@functools.lru_cache(1 << 18)
def is_legal(word: str) -> bool:
    """A word of a legal form, by itself, with swapped letters or mistyped."""
    if word in fixed.LEGAL_FORMS or len(word) == 3 and tuple(sorted(word)) in _ANAGRAMS:
        return True
    if len(word) < 6 or not word.isalpha() or word in fixed.NOT_LEGAL:
        return False
    return word.startswith(fixed.LEGAL_BEGINNINGS) or any(within(word, form, 1 + (len(form) >= 9)) for form in fixed.LEGAL_WORDS)


@functools.lru_cache(1 << 18)
def is_glued(piece: str, several: bool, french: bool, letters: bool) -> bool:
    """A legal form run together or mistyped. Of several words at most one edit; short ones only as they are, but for
    single letters in France."""
    forms = [*fixed.GLUED_FORMS, *(fixed.GLUED_FORMS_FRANCE if french else ())]
    if piece in forms:
        return True
    if len(piece) >= 4 or french and letters and len(piece) > 1:
        return any(within(piece, form, 2 if len(form) >= 8 and not several else 1) for form in forms)
    return False


@functools.lru_cache(1 << 18)
def legal_name(joined: str) -> str:
    """The one name of a legal form; the nearest where it is mistyped; '' where none is near."""
    if joined in fixed.LEGAL_NAMES:
        return fixed.LEGAL_NAMES[joined]
    if len(joined) >= 4:
        for edits in (1, 2):
            for form, name in fixed.LEGAL_NAMES.items():
                if len(form) >= (3 if edits == 1 else 8) and within(joined, form, edits):
                    return name
    return ""


def india_sounds(word: str) -> str:
    return re.sub(r"([a-z])\1+", r"\1", _SOUNDS.sub(lambda m: dict(fixed.INDIA_SPELLINGS)[m[0]], word))


@functools.lru_cache(1 << 18)
def _form(word: str, country: str) -> str:
    """A word's one form, '' for a word that says nothing."""
    if word in fixed.NULL_WORDS:
        return ""
    bare = word.lstrip("0")
    if bare != word:
        word = bare if bare[:1].isdigit() else "0" + bare
    word = fixed.COUNTRY_FORMS.get(country, {}).get(word, word)
    return fixed.WORD_FORMS.get(word, word)


def forms(words: list[str], country: str) -> list[str]:
    return [f for w in words if (f := _form(w, country)) and f not in fixed.WEB_WORDS]


class _Edges:
    """A name's words from which legal forms are taken away at both ends, at most four words at a time, the most first; one
    word stays."""

    def __init__(self, words: list[str], legal: list[bool], french: bool):
        self.words, self.legal, self.french = words, legal, french

    def _goes(self, lo: int, hi: int) -> bool:
        piece = self.words[lo:hi]
        if all(self.legal[lo:hi]):
            return True
        several = len(piece) > 1
        return not any(w.isdigit() for w in piece) and is_glued("".join(piece), several, self.french, several and max(map(len, piece)) == 1)

    def kept(self) -> range:
        lo, hi = 0, len(self.words)
        while cut := next((k for k in range(min(4, hi - lo - 1), 0, -1) if self._goes(hi - k, hi)), 0):
            hi -= cut
        while cut := next((k for k in range(min(4, hi - lo - 1), 0, -1) if self._goes(lo, lo + k)), 0):
            lo += cut
        return range(lo, hi)


def name_parts(cleaned: str, country: str) -> tuple[list[str], list[str], str]:
    """All words of a name, those of its core, and its legal form."""
    words = forms(cleaned.split(), country)
    if words[:2] == ["m", "s"] and len(words) > 2:
        words = words[2:]
    if country and len(words) > 1:
        words = [w for w in words if w != country] or words
    titles = fixed.HONORIFICS | (fixed.INDIA_FORMS if country == "india" else frozenset())
    legal = [w in titles or is_legal(w) for w in words]  # before Indian sounds change what is mistyped
    inner = _Edges(words, legal, country == "france").kept()
    heard = list(map(india_sounds, words)) if country == "india" else words
    core = [i for i in inner if not legal[i] and not is_legal(heard[i])]
    taken = [w for i, w in enumerate(words) if i not in set(core) and w not in fixed.LEGAL_FILLERS and w not in titles]
    return heard, [heard[i] for i in core] or heard, legal_name("".join(taken)) if core else ""


@functools.cache
def _phrases(country: str) -> dict[str, list[tuple[list[str], str]]]:
    """State phrases by their first word, the longest first."""
    out: dict[str, list[tuple[list[str], str]]] = {}
    for phrase, code in sorted(fixed.STATES.get(country, {}).items(), key=lambda x: -len(x[0])):
        out.setdefault(phrase.split()[0], []).append((phrase.split(), code))
    return out


def address_words(cleaned: str, country: str) -> list[str]:
    """An address's words: states by their codes, mail routing and post boxes left out."""
    words, phrases, out, i = cleaned.split(), _phrases(country), [], 0
    if country == "france":
        stay = []
        for w in words:
            routed = bool(stay) and stay[-1] is None and w.isdigit() and len(w) <= 5
            stay += [None] if w in fixed.MAIL_ROUTING else [] if routed else [w]
            if routed:
                stay[-1] = ""
        words = [w for w in stay if w]
    while i < len(words):
        hit = next(((len(p), code) for p, code in phrases.get(words[i], ()) if words[i : i + len(p)] == p), (1, words[i]))
        out.append(hit[1])
        i += hit[0]
    return _BOX.sub("", " ".join(forms(out, country))).split()


def address_parts(words: list[str]) -> tuple[list[str], str, str, str, str, str]:
    """Numbers, postal code, unit, house number, street and street type."""
    at = [i for i, w in enumerate(words) if is_number(w)]
    ahead = {i: words[i + 1 : min(i + 6, j)] for i, j in zip(at, [*at[1:], len(words)])}
    # a number with a street type behind it, and no other number between, is the house's, whatever the order of parts
    house_at = next((i for i in at if not fixed.STREET_TYPES.isdisjoint(ahead[i])), None)
    codes = [words[i] for i in at if words[i].isdigit() and 5 <= len(words[i]) <= 6 and (house_at is None or words[i] != words[house_at])]
    postal = codes[-1] if codes else ""
    unit = next((words[i] for i in at if i and words[i - 1] in fixed.UNIT_WORDS), "")
    if house_at is None:
        house_at = next((i for i in at if words[i] not in (postal, unit)), None)
    if house_at is None:
        return [words[i] for i in at], postal, unit, "", "", ""
    behind = words[house_at + 1 + (words[house_at + 1 : house_at + 2] != [] and words[house_at + 1] in fixed.HOUSE_SUFFIXES) :][:5]
    behind = [w for w in behind if not is_number(w) and w not in fixed.UNIT_WORDS]
    kind = next((w for w in behind if w in fixed.STREET_TYPES), "")
    street = next((w for w in behind if w not in fixed.STREET_TYPES and w not in fixed.STREET_PARTICLES), "")
    return [words[i] for i in at], postal, unit, words[house_at], street, kind


_TEXT, _LIST = pa.string(), pa.list_(pa.string())
PARTS = pa.schema([("name_n", _TEXT), ("core", _TEXT), ("core_toks", _LIST), ("addr_n", _TEXT), ("addr_toks", _LIST), ("full", _TEXT), ("compact", _TEXT), ("initials", _TEXT), ("first_tok", _TEXT), ("name_nums", _LIST), ("addr_nums", _LIST), ("postal", _TEXT), ("unit", _TEXT), ("house", _TEXT), ("street", _TEXT), ("legal", _TEXT), ("street_type", _TEXT)])


def parts(name: str, address: str, country: str) -> tuple:
    """The columns of PARTS, of a cleaned name and address."""
    words, core, legal = name_parts(name, country)
    place = address_words(address, country)
    numbers, postal, unit, house, street, kind = address_parts(place)
    core_text, place_text = " ".join(core), " ".join(place)
    initials = "".join(w[0] for w in core) if len(core) > 1 else ""
    return (" ".join(words), core_text, core, place_text, place, f"{core_text} {place_text}".strip(), "".join(core), initials, core[0] if core else "", [w for w in core if is_number(w)], numbers, postal, unit, house, street, legal, kind)


def prepare(records: DataFrame, lexicon: dict[str, str] | None = None) -> DataFrame:
    """records (name, address, country and others) with PARTS, the phonetic keys and translit (an Indic name). Missing texts
    are ''. lexicon: Latin forms of native words."""
    own = records.columns
    cleaned = records.withColumns({"_n": text.clean(text.unleet(F.coalesce("name", F.lit(""))), lexicon), "_a": text.clean(F.col("address"), lexicon), "_c": text.country_key(F.col("country"))})

    def run(batches):
        for batch in batches:
            rows = [parts(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("_n", "_a", "_c")))]
            made = [pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [()] * len(PARTS), PARTS.types)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *made], names=[*own, *PARTS.names])

    kinds = {_TEXT: StringType(), _LIST: ArrayType(StringType())}
    schema = StructType([*records.schema.fields, *(StructField(f.name, kinds[f.type]) for f in PARTS)])
    heard = F.transform(F.filter("core_toks", lambda t: ~t.rlike("^[0-9]+[a-z]?$")), text.skeleton)
    return cleaned.mapInArrow(run, schema).withColumns({"meta_first": text.skeleton(F.col("first_tok")), "sdx_first": text.soundex(F.col("first_tok")), "phon": F.array_join(F.array_sort(heard), " "), "translit": F.coalesce(F.rlike("name", F.lit("[ऀ-෿]")), F.lit(False))})
