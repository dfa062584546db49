"""Dish metadata from text: servings, times, difficulty, keywords.

Each ``*_col`` takes the lower-cased text column and returns a column; ordered regex cascades
are ``coalesce`` of ``regexp_extract`` and keyword lists are literal arrays filtered by
``contains``, so nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicon as lx
from .text import ColumnOrName, col, contains_any, first_match, let


def _lower(text: ColumnOrName) -> Column:
    return F.lower(col(text))


# ---------------------------------------------------------------------------------- B9 / B10
def servings_col(text: ColumnOrName, patterns: Sequence[str] = lx.SERVINGS_PATTERNS, infer: bool = True) -> Column:
    """Servings as text: a range stays '4-6', a single number is normalised ('06' -> '6')."""
    def found(m: Column) -> Column:
        return F.when(m.contains("-"), m).otherwise(m.try_cast("bigint").cast("string"))

    def guess(t: Column) -> Column:
        out = None
        for words, value in lx.SERVINGS_HINTS:
            if value == "pieces":
                v = F.nullif(F.regexp_extract(t, lx.PIECES_PATTERN, 1), F.lit("")).try_cast("bigint").cast("string")
            else:
                v = F.lit(str(value))
            cond = contains_any(t, words)
            out = F.when(cond, v) if out is None else out.when(cond, v)
        return out

    def of(t: Column) -> Column:
        return let(first_match(t, patterns), lambda m: F.when(m.isNotNull(), found(m)).otherwise(guess(t)) if infer else found(m))

    return let(_lower(text), of)


def extract_servings(df: DataFrame, text: str, out: str = "servings", infer: bool = True) -> DataFrame:
    return df.withColumn(out, servings_col(text, infer=infer))


# ---------------------------------------------------------------------------------- B11 / B12
def times_col(text: ColumnOrName, prep=lx.PREP_PATTERNS, cook=lx.COOK_PATTERNS, total=lx.TOTAL_PATTERNS,
              infer: bool = True) -> Column:
    """struct<prepTime, cookTime, totalTime> as matched text ('30 min', '1-2 hours')."""
    t = _lower(text)

    def prepared(t: Column) -> Column:
        p = first_match(t, prep)
        if not infer:
            return p
        guess = None
        for words, value in lx.PREP_HINTS:
            cond = contains_any(t, words)
            guess = F.when(cond, F.lit(value)) if guess is None else guess.when(cond, F.lit(value))
        return F.coalesce(p, guess)

    # Each field by itself, so that one that isn't asked for costs nothing.
    return F.struct(let(t, prepared).alias("prepTime"), first_match(t, cook).alias("cookTime"),
                    first_match(t, total).alias("totalTime"))


def extract_times(df: DataFrame, text: str, out: str = "times", infer: bool = True) -> DataFrame:
    return df.withColumn(out, times_col(text, infer=infer))


# ---------------------------------------------------------------------------------------- B13
def difficulty_col(text: ColumnOrName, patterns=lx.DIFFICULTY_PATTERNS, easy=lx.EASY_HINTS, hard=lx.HARD_HINTS,
                   overrides: Sequence[str] | None = lx.MEDIUM_OVERRIDES) -> Column:
    def of(t: Column) -> Column:
        labelled = F.lower(first_match(t, patterns))
        d = F.coalesce(labelled, F.when(contains_any(t, easy), F.lit("easy")).when(contains_any(t, hard), F.lit("hard")))
        if overrides:
            d = F.when(contains_any(t, overrides), F.lit("medium")).otherwise(d)
        return d

    return let(_lower(text), of)


def extract_difficulty(df: DataFrame, text: str, out: str = "difficulty") -> DataFrame:
    return df.withColumn(out, difficulty_col(text))


# ----------------------------------------------------------------------------- B14 / B16 / B15
def _kw_array(keywords: Sequence[str]) -> Column:
    return F.array(*[F.lit(k) for k in keywords])


def _word_match(t: Column, k: Column) -> Column:
    return t.rlike(F.concat(F.lit(r"\b"), k, F.lit(r"\b")))


def _found(t: Column, whole_word: bool):
    return (lambda k: _word_match(t, k)) if whole_word else (lambda k: t.contains(k))


def first_keyword_col(text: ColumnOrName, keywords: Sequence[str], whole_word: bool = False) -> Column:
    """First keyword, in list order, found in the lower-cased text (substring unless whole_word)."""
    return let(_lower(text), lambda t: F.get(F.filter(_kw_array(keywords), _found(t, whole_word)), 0))


def first_keyword(df: DataFrame, text: str, keywords: Sequence[str], out: str, whole_word: bool = False) -> DataFrame:
    return df.withColumn(out, first_keyword_col(text, keywords, whole_word))


def all_keywords_col(text: ColumnOrName, keywords: Sequence[str], whole_word: bool = False) -> Column:
    """All keywords found, in list order; NULL when none."""
    found = let(_lower(text), lambda t: F.filter(_kw_array(keywords), _found(t, whole_word)))
    return let(found, lambda xs: F.when(F.size(xs) > 0, xs))


def all_keywords(df: DataFrame, text: str, keywords: Sequence[str], out: str, whole_word: bool = False) -> DataFrame:
    return df.withColumn(out, all_keywords_col(text, keywords, whole_word))


def classify_by_groups_col(text: ColumnOrName, groups=lx.MEAL_GROUPS) -> Column:
    """Label of the first group that has a word contained in the text."""
    def of(t: Column) -> Column:
        out = None
        for label, words in groups:
            cond = contains_any(t, words)
            out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
        return out

    return let(_lower(text), of)


def classify_by_groups(df: DataFrame, text: str, out: str, groups=lx.MEAL_GROUPS) -> DataFrame:
    return df.withColumn(out, classify_by_groups_col(text, groups))


# ---------------------------------------------------------------------------------------- B19
def direction_servings_col(directions: ColumnOrName) -> Column:
    """Servings from the first direction that states them ('serves 4', 'makes about 24')."""
    def one(d):
        low = F.lower(d)
        s = F.nullif(F.regexp_extract(low, lx.SERVINGS_PATTERNS[0], 1), F.lit(""))
        s = F.when(s.contains("-"), s).otherwise(s.try_cast("bigint").cast("string"))
        m = F.nullif(F.regexp_extract(low, lx.DIRECTION_MAKES, 1), F.lit("")).try_cast("bigint").cast("string")
        return F.coalesce(s, m)
    return F.get(F.filter(F.transform(col(directions), one), lambda x: x.isNotNull()), 0)


def direction_times_col(directions: ColumnOrName) -> Column:
    return times_col(F.array_join(col(directions), " "), lx.PREP_PATTERNS_DIRECTIONS, lx.COOK_PATTERNS_DIRECTIONS,
                     lx.TOTAL_PATTERNS_DIRECTIONS, infer=False)
