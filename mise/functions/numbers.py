"""Numbers and categories from loosely typed text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicon as lx
from .text import ColumnOrName, col, contains_any, js_trim

_FIRST_NUMBER = r"\d+\.?\d*"


def to_number_col(c: ColumnOrName, fractions: bool = False, hours: bool = False) -> Column:
    """First numeric value: '2-4' -> 2, '30-45 minutes' -> 30, '3.5' -> 3.5, 'a pinch' -> NULL.

    ``fractions=True`` reads '1/2' as 0.5 and '1 1/2' as 1.5 (by default they give 1, as the
    convention does); ``hours=True`` turns a value stated in hours into minutes.
    """
    s = js_trim(col(c).cast("string"))
    v = F.nullif(F.regexp_extract(s, _FIRST_NUMBER, 0), F.lit("")).try_cast("double")
    if fractions:
        mixed = r"^(\d+)\s+(\d+)/(\d+)"
        frac = r"^(\d+)/(\d+)"
        v = (F.when(s.rlike(mixed), F.regexp_extract(s, mixed, 1).try_cast("double")
                    + F.regexp_extract(s, mixed, 2).try_cast("double") / F.regexp_extract(s, mixed, 3).try_cast("double"))
             .when(s.rlike(frac), F.regexp_extract(s, frac, 1).try_cast("double") / F.regexp_extract(s, frac, 2).try_cast("double"))
             .otherwise(v))
    if hours:
        v = F.when(F.lower(s).rlike(r"\b(hr|hour)"), v * 60).otherwise(v)
    return v


def to_integer_col(c: ColumnOrName, fractions: bool = False, hours: bool = False) -> Column:
    """Rounded (half up, as the loader does) integer of :func:`to_number_col`; NULL beyond the
    integers."""
    return F.floor(to_number_col(c, fractions, hours) + F.lit(0.5)).try_cast("int")


def to_number(df: DataFrame, column: str, out: str | None = None, **kw) -> DataFrame:
    return df.withColumn(out or column, to_number_col(column, **kw))


def to_integer(df: DataFrame, column: str, out: str | None = None, **kw) -> DataFrame:
    return df.withColumn(out or column, to_integer_col(column, **kw))


def leading_int_col(c: ColumnOrName) -> Column:
    """Integer prefix of a string ('12abc' -> 12), NULL when none."""
    return F.nullif(F.regexp_extract(js_trim(col(c)), r"^[+-]?\d+", 0), F.lit("")).try_cast("int")


def normalize_by_synonyms_col(c: ColumnOrName, table: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Value of the first entry one of whose synonyms is contained in the lower-cased text."""
    low = F.lower(col(c))
    out = None
    for value, words in table:
        cond = contains_any(low, words)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out


def normalize_by_synonyms(df: DataFrame, column: str, table=lx.DIFFICULTY_SYNONYMS, out: str | None = None) -> DataFrame:
    """B22 (difficulty, default table) / B23 (``table=lexicon.MEAL_SYNONYMS``)."""
    return df.withColumn(out or column, normalize_by_synonyms_col(column, table))
