"""A lexicon of native words and their Latin forms, learnt from records that are known to be one entity's: their words are
aligned in order, and what is aligned often enough is kept."""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import indic, text
from .metrics import indel_ratio, jaro_winkler
from .prepare import india_sounds

# Signs between the words of a raw text.
_BETWEEN = re.compile(r"""[\s,.;:()\[\]{}/\\\-&'"|#@*<>_!?+=]+""")
_NATIVE = re.compile("[ऀ-෿]")
#: Likeness that aligns two words, what one word for two needs more and weighs more, and how much likelier than either it must be.
LEAST, FOR_TWO, WEIGHT_TWO, BETTER = 0.45, 0.15, 1.2, 0.1
#: Words of a text at most, on either side.
NATIVE_WORDS, LATIN_WORDS = 16, 24


def native_words(raw: str) -> list[tuple[str, str]]:
    """(key, sound in Latin) of the native words of a text."""
    keys = [indic.native_key(w) for w in _BETWEEN.split(raw) if _NATIVE.search(w)]
    heard = [(k, india_sounds("".join(c for c in indic.romanise(k).lower() if c.isalnum()))) for k in keys]
    return [(k, h) for k, h in heard if h]


def align(native: list[tuple[str, str]], latin: list[str], least: float = LEAST) -> list[tuple[str, str]]:
    """(native key, one Latin word or two), in order, of the greatest sum of likenesses; words may stay alone."""
    sounds = [india_sounds(w) for w in latin]

    def steps(i: int, j: int):
        """What the first words left can do: score, native words and Latin words used up."""
        one = jaro_winkler(native[i][1], sounds[j])
        if one >= least:
            yield one, 1, 1
        if j + 1 < len(latin):
            single = max(indel_ratio(native[i][1], s) for s in sounds[j : j + 2]) / 100
            two = indel_ratio(native[i][1], sounds[j] + sounds[j + 1]) / 100
            if two >= max(least + FOR_TWO, single + BETTER):
                yield WEIGHT_TWO * two, 1, 2
        yield 0.0, 1, 0
        yield 0.0, 0, 1

    @functools.cache
    def best(i: int, j: int) -> tuple[float, tuple]:
        if i == len(native) or j == len(latin):
            return 0.0, ()
        found = [(score + best(i + a, j + b)[0], a, b) for score, a, b in steps(i, j)]
        top = max(found, key=lambda x: x[0])
        rest = best(i + top[1], j + top[2])[1]
        return top[0], ((native[i][0], " ".join(latin[j : j + top[2]])), *rest) if top[1] and top[2] else rest

    return list(best(0, 0)[1])


def mined(pairs: DataFrame) -> DataFrame:
    """(native, latin, ent) of pairs (native_text, latin_text, ent)."""
    src = pairs.select(F.coalesce("native_text", F.lit("")).alias("a"), text.clean(F.col("latin_text")).alias("b"), "ent").filter(F.rlike("a", F.lit("[ऀ-෿]")))
    kind = pairs.schema["ent"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = []
            for a, b, ent in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ent"))):
                native, latin = native_words(a), [w for w in b.split() if not w.isdigit()]
                if native and latin and len(native) <= NATIVE_WORDS and len(latin) <= LATIN_WORDS:
                    out += [(n, x, ent) for n, x in align(native, latin)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], batch.schema.field("ent").type)], names=["native", "latin", "ent"])

    return src.mapInArrow(run, f"native string, latin string, ent {kind}")


def kept(found: DataFrame, share: float = 0.6, entities: int = 3) -> DataFrame:
    """(native, latin): of each native word the form it is aligned with most, if in so large a share and for so many entities."""
    counts = found.groupBy("native", "latin").agg(F.count("*").alias("n"), F.countDistinct("ent").alias("e"))
    w = Window.partitionBy("native")
    ranked = counts.withColumns({"k": F.row_number().over(w.orderBy(F.desc("n"), "latin")), "all": F.sum("n").over(w)})
    return ranked.filter((F.col("k") == 1) & (F.col("n") >= share * F.col("all")) & (F.col("e") >= entities)).select("native", "latin")


def pairs_of(s1: DataFrame, rec: DataFrame, truth: DataFrame, most: int = 800_000) -> DataFrame:
    """(native_text, latin_text, ent): names and addresses of true pairs whose record has native script; of more than most
    pairs, the first by a hash."""
    a = s1.select(F.col("id").alias("s1_id"), F.col("name").alias("n1"), F.col("address").alias("a1"))
    b = rec.select(F.col("id").alias("rec_id"), F.col("name").alias("n2"), F.col("address").alias("a2"))
    native = F.rlike(F.concat_ws(" ", "n2", "a2"), F.lit("[ऀ-෿]"))
    met = truth.join(b.filter(native), "rec_id").join(a, "s1_id").orderBy(F.xxhash64("s1_id", "rec_id"), "rec_id").limit(most)
    return met.select(F.col("s1_id").alias("ent"), F.explode(F.array(F.struct(F.col("n2").alias("native_text"), F.col("n1").alias("latin_text")), F.struct(F.col("a2").alias("native_text"), F.col("a1").alias("latin_text")))).alias("x")).select("x.native_text", "x.latin_text", "ent")


def learn(s1: DataFrame, rec: DataFrame, truth: DataFrame) -> dict[str, str]:
    """The lexicon of true pairs, a table of words."""
    return {r.native: r.latin for r in kept(mined(pairs_of(s1, rec, truth))).collect()}
