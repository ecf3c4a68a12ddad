"""Romanisation of the Indic scripts, whose blocks are laid out alike: a text is read in syllables."""

from __future__ import annotations

import re
import unicodedata

from . import fixed

BLOCKS = range(0x0900, 0x0E00, 0x80)


def _table(runs: dict[int, list[str]]) -> dict[int, str]:
    return {start + k: latin for start, row in runs.items() for k, latin in enumerate(row)}


CONSONANTS, VOWELS, VOWEL_SIGNS, SIGNS = map(_table, (fixed.INDIC_CONSONANTS, fixed.INDIC_VOWELS, fixed.INDIC_VOWEL_SIGNS, fixed.INDIC_SIGNS))
_ALONE = VOWELS | SIGNS | {fixed.INDIC_ZERO + d: str(d) for d in range(10)} | dict.fromkeys(fixed.INDIC_STOPS, " ")
_class = lambda places: "[" + "".join(chr(b + p) for b in BLOCKS for p in places) + "]"
_ANY = f"[{chr(BLOCKS[0])}-{chr(0x0DFF)}]"
_SYLLABLE = re.compile(f"({_class(CONSONANTS)}){_class([fixed.INDIC_NUKTA])}?(?:({_class(VOWEL_SIGNS)})|({_class([fixed.INDIC_VIRAMA])})|(?={_ANY})()|(?!{_ANY}))|{_ANY}")
_RUN, _DOUBLE = re.compile(f"{_ANY}+"), re.compile(r"([aeiou])\1+")
_WORD = re.compile(f"(?:{_ANY}|[​-‍])+")
_JOINERS = str.maketrans("", "", "​‌‍﻿")


def _latin(m: re.Match) -> str:
    if m[1] is None:
        return _ALONE.get(ord(m[0]) & 0x7F, "")
    letter, block = ord(m[1]) & 0x7F, ord(m[1]) & ~0x7F
    latin = CONSONANTS[letter]
    if m[2]:
        return latin + VOWEL_SIGNS[ord(m[2]) & 0x7F]
    if m[3]:
        return latin
    if m[4] is None and block in fixed.SCHWA_BLOCKS:  # the last of a word
        conjunct = m.start() and ord(m.string[m.start() - 1]) == block + fixed.INDIC_VIRAMA
        return latin + "a" * bool(conjunct and letter in fixed.SCHWA_KEPT)
    return latin + "a"


def native_key(word: str) -> str:
    """What a word of the lexicon is found by: composed, without joiners."""
    return unicodedata.normalize("NFC", word).translate(_JOINERS)


def romanise(text: str, lexicon: dict[str, str] | None = None) -> str:
    """The text with its Indic runs in Latin letters, doubled vowels as one; words of the lexicon as it has them."""
    if lexicon:
        text = _WORD.sub(lambda m: f" {known} " if (known := lexicon.get(native_key(m[0]))) else m[0], text)
    return _RUN.sub(lambda m: _DOUBLE.sub(r"\1", _SYLLABLE.sub(_latin, m[0])), text)
