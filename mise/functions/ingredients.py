"""Ingredient line parsing (B4, B5, B6) as column expressions.

``parse_ingredient_line`` returns struct<name, quantity, unit, notes>; ``amount_name`` returns
struct<amount, name>.  Both are applied to arrays with ``transform``, so a whole dish is parsed
inside one projection, in the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicon as lx
from .text import ColumnOrName, col, js_trim

INGREDIENT_TYPE = "struct<name:string,quantity:string,unit:string,notes:string>"

_NOTES = r"\(([^)]+)\)"
_RANGE = r"(\d+\.?\d*)\s*-\s*(\d+\.?\d*)"
_FRACTION = r"(\d+/\d+|\d+\s+\d+/\d+)"
_NUMBER = r"(\d+\.?\d*)"
_NUMBER_POST = r"(\d+\.?\d*|\d*\.?\d+)"


def unit_pattern(units=lx.UNITS) -> str:
    """Regex for a unit at the start of the text.

    Units are escaped and tried longest first, case-insensitively except the single letters
    ``T`` (tablespoon) and ``t`` (teaspoon); a trailing period is part of the unit; the unit
    must be followed by a non-word character or the end.  Group 1 is the unit text.
    """
    canon = []
    for u in units:
        base = u.rstrip(".")
        if base in ("T", "t"):
            continue
        if base.lower() not in canon:
            canon.append(base.lower())
    canon.sort(key=lambda s: (-len(s), s))
    alt = "|".join(re.escape(u) for u in canon)
    return r"^((?i:" + alt + r")\.?|T\.?|t\.?)(\W|$)"


UNIT_RE = unit_pattern()


def js_number_text(c: Column) -> Column:
    """Text of a parsed number the way a JSON writer prints it: '2.' -> '2', '1.50' -> '1.5'."""
    # On the text, so that no digits are lost: leading zeros, then zeros after the point, then the point.
    t = F.regexp_replace(F.regexp_replace(c, r"^0+(?=\d)", ""), r"^\.", "0.")
    return F.when(t.contains("."), F.regexp_replace(F.regexp_replace(t, r"0+$", ""), r"\.$", "")).otherwise(t)


SEP = "\u0001"
# One pass for the leading quantity: groups 1-2 range, 3 fraction, 4 number, 5 the rest.
_QTY_LEAD = r"(?s)^(?:" + _RANGE + "|" + _FRACTION + "|" + _NUMBER + r")?(.*)$"
_RANGE_ANY = r"(?s)^(.*?)" + _RANGE + r"(.*)$"
_FRACTION_ANY = r"(?s)^(.*?)" + _FRACTION + r"(.*)$"
_NOTES_FIRST = r"(?s)^(.*?)" + _NOTES + r"(.*)$"


def _groups(text: Column, pattern: str, n: int, needed: str = "") -> Column:
    """All ``n`` groups of one match in a single regex pass (array of one when there is no match).
    A text that holds SEP itself has its groups extracted one by one; one without the character
    ``needed`` can't match and isn't searched."""
    one_pass = F.split(F.regexp_replace(text, pattern, SEP.join(f"${i}" for i in range(1, n + 1))), SEP, -1)
    each = F.when(text.rlike(pattern), F.array(*[F.regexp_extract(text, pattern, i) for i in range(1, n + 1)])).otherwise(F.array(text))
    found = F.when(text.contains(SEP), each).otherwise(one_pass)
    return F.when(~text.contains(needed), F.array(text)).otherwise(found) if needed else found


def _stage(arr: Column, **fields) -> Column:
    """One ``transform`` stage: every field is computed once per element from the previous
    stage's struct ``s`` (fields are ``lambda s: Column``)."""
    return F.transform(arr, lambda s: F.struct(*[f(s).alias(k) for k, f in fields.items()]))


def _keep(*names):
    return {n: (lambda s, n=n: s[n]) for n in names}


def _unit_stages(arr: Column, unit_re: str, text: str, keep: tuple) -> Column:
    """Adds ``unit`` and replaces ``text`` by what follows the unit."""
    arr = _stage(arr, **_keep(*keep, text), _u=lambda s: F.regexp_extract(s[text], unit_re, 1))
    return _stage(arr, **_keep(*keep),
                  unit=lambda s: (F.when(s["_u"] == "", F.lit(None).cast("string"))
                                  .when(s["_u"].isin("T", "T."), F.lit("T"))
                                  .otherwise(F.lower(F.rtrim(s["_u"], F.lit("."))))),
                  **{text: lambda s: F.when(s["_u"] == "", s[text])
                                      .otherwise(js_trim(s[text].substr(F.length(s["_u"]) + 1, F.length(s[text]))))})


def _parse_array(lines: Column, style: str, unit_re: str) -> Column:
    """Parse an array of lines into array<struct<name, quantity, unit, notes>>.

    Each step is its own ``transform`` so every regular expression runs once per line (Spark
    does not share sub-expressions across CASE branches or lambda references)."""
    if style == "line":
        a = F.transform(lines, lambda l: F.struct(js_trim(l).alias("t0")))
        a = _stage(a, t0=lambda s: s["t0"], notes=lambda s: F.nullif(F.regexp_extract(s["t0"], _NOTES, 1), F.lit("")))
        a = _stage(a, notes=lambda s: s["notes"],
                   t1=lambda s: F.when(s["notes"].isNotNull(), js_trim(_remove_first(s["t0"], _NOTES)))
                                 .otherwise(s["t0"]))
        a = _stage(a, notes=lambda s: s["notes"], p=lambda s: _groups(s["t1"], _QTY_LEAD, 5))
        a = _stage(a, notes=lambda s: s["notes"],
                   quantity=lambda s: (F.when(s["p"][0] != "", F.concat(s["p"][0], F.lit("-"), s["p"][1]))
                                       .when(s["p"][2] != "", js_trim(s["p"][2]))
                                       .when(s["p"][3] != "", js_number_text(s["p"][3]))),
                   t2=lambda s: js_trim(s["p"][4]))
        a = _unit_stages(a, unit_re, "t2", ("notes", "quantity"))
        return F.transform(a, lambda s: F.struct(js_trim(s["t2"]).alias("name"), s["quantity"].alias("quantity"),
                                                 s["unit"].alias("unit"), s["notes"].alias("notes")))

    a = F.transform(lines, lambda l: F.struct(
        F.regexp_replace(js_trim(l), r"^(?:[*\-•◦→]+\.?\s*|\d+[.)](?:\s+|$))", "").alias("c")))
    a = _stage(a, c=lambda s: s["c"], r=lambda s: _groups(s["c"], _RANGE_ANY, 4, "-"))
    a = _stage(a, c=lambda s: s["c"], r=lambda s: s["r"],
               f=lambda s: F.when(F.size(s["r"]) == 1, _groups(s["c"], _FRACTION_ANY, 3, "/")))
    a = _stage(a, c=lambda s: s["c"], r=lambda s: s["r"], f=lambda s: s["f"],
               n=lambda s: F.when((F.size(s["r"]) == 1) & (F.size(s["f"]) == 1),
                                  F.regexp_extract(s["c"], "^" + _NUMBER_POST, 0)))
    rng = lambda s: F.size(s["r"]) > 1
    frac = lambda s: F.size(s["f"]) > 1
    num = lambda s: F.coalesce(s["n"], F.lit("")) != ""
    a = _stage(a,
               quantity=lambda s: (F.when(rng(s), F.concat(s["r"][1], F.lit("-"), s["r"][2]))
                                   .when(frac(s), js_trim(s["f"][1]))
                                   .when(num(s), js_number_text(s["n"]))),
               t2=lambda s: (F.when(rng(s), js_trim(F.concat(s["r"][0], s["r"][3])))
                             .when(frac(s), js_trim(F.concat(s["f"][0], s["f"][2])))
                             .when(num(s), js_trim(s["c"].substr(F.length(s["n"]) + 1, F.length(s["c"]))))
                             .otherwise(s["c"])))
    a = _unit_stages(a, unit_re, "t2", ("quantity",))
    a = _stage(a, **_keep("quantity", "unit", "t2"), nt=lambda s: _groups(s["t2"], _NOTES_FIRST, 3, "("))
    return F.transform(a, lambda s: F.struct(
        js_trim(F.when(F.size(s["nt"]) > 1, js_trim(F.concat(s["nt"][0], s["nt"][2]))).otherwise(s["t2"])).alias("name"),
        s["quantity"].alias("quantity"), s["unit"].alias("unit"),
        F.when(F.size(s["nt"]) > 1, s["nt"][1]).alias("notes")))


def _remove_first(text: Column, pattern: str) -> Column:
    """Remove the leftmost match of ``pattern`` (which must not use group references)."""
    return F.regexp_replace(text, "^(.*?)" + pattern, "$1")


def parse_ingredient_line(line: Column, style: str = "line", units=None) -> Column:
    """struct<name, quantity, unit, notes> for one ingredient line.

    ``style='line'`` (structured rows): notes in parentheses first, then a leading range,
    fraction or number, then a unit.  ``style='post'`` (free posts): bullets and list numbers
    are stripped, a range or fraction may appear anywhere, notes are taken last.  ``units``
    replaces the unit list.
    """
    unit_re = UNIT_RE if units is None else unit_pattern(units)
    return F.get(_parse_array(F.array(line), style, unit_re), 0)


_POST_SKIP = r"(?i)^(ingredient|instruction|direction|step|method|prep|cook)"


def parse_ingredient_lines_col(lines: ColumnOrName, style: str = "line", units=None) -> Column:
    """Parse every element of an array of lines.  Post style drops blank, short and header-like
    lines and entries whose name ends up empty."""
    lines = col(lines)
    unit_re = UNIT_RE if units is None else unit_pattern(units)
    if style == "line":
        return _parse_array(lines, "line", unit_re)
    kept = F.filter(F.transform(lines, js_trim), lambda l: (F.length(l) >= 3) & ~l.rlike(_POST_SKIP))
    return F.filter(_parse_array(kept, "post", unit_re), lambda s: s["name"] != "")


def parse_ingredient_lines(df: DataFrame, lines: str, out: str = "ingredients", style: str = "line",
                           units=None) -> DataFrame:
    """``df[lines]`` is array<string>; adds ``out`` as array<ingredient>."""
    return df.withColumn(out, parse_ingredient_lines_col(lines, style, units))


# ------------------------------------------------------------------------------------------ B4
_SEP_MATCH = r"^(.+?)\s*[-–—]\s*(.+)$"
_SEP_SPLIT = r"\s*[-–—]\s*|\s*:\s*"


def amount_name(line: Column, style: str = "post") -> Column:
    """struct<amount, name> by separator: dash, then colon, then a leading amount."""
    if style == "post":
        cleaned = js_trim(F.regexp_replace(js_trim(line), r"^[*\-+•]\s*", ""))
        m_amount = F.regexp_extract(cleaned, _SEP_MATCH, 1)
        m_name = F.regexp_extract(cleaned, _SEP_MATCH, 2)
        has_match = cleaned.rlike(_SEP_MATCH)
    else:
        cleaned = line
        has_match = F.lit(False)
        m_amount = m_name = F.lit("")
    parts = F.split(cleaned, _SEP_SPLIT, -1)
    lead = F.regexp_extract(cleaned, lx.LEADING_AMOUNT, 1)
    amount = (F.when(has_match, js_trim(m_amount))
              .when(F.size(parts) >= 2, js_trim(F.get(parts, 0)))
              .when(lead != "", js_trim(lead))
              .otherwise(F.lit("")))
    name = (F.when(has_match, js_trim(m_name))
            .when(F.size(parts) >= 2, js_trim(F.array_join(F.slice(parts, 2, F.size(parts) - 1), " ")))
            .when(lead != "", js_trim(cleaned.substr(F.length(lead) + 1, F.length(cleaned) + 1)))
            .otherwise(cleaned))
    return F.struct(amount.alias("amount"), name.alias("name"))


def amount_name_col(lines: ColumnOrName, style: str = "post") -> Column:
    lines = col(lines)
    if style == "post":
        lines = F.filter(lines, lambda l: F.length(js_trim(l)) >= 3)
    return F.transform(lines, lambda l: amount_name(l, style))


def parse_amount_name(df: DataFrame, lines: str, out: str = "ingredients", style: str = "post") -> DataFrame:
    """Separator-style parse, kept for fidelity (a hyphenated word splits, see README)."""
    return df.withColumn(out, amount_name_col(lines, style))


def amount_name_to_ingredient(s: Column) -> Column:
    """Canonical ingredient struct from {amount, name}: the amount becomes the quantity text."""
    return F.struct(s["name"].alias("name"), F.nullif(s["amount"], F.lit("")).alias("quantity"),
                    F.lit(None).cast("string").alias("unit"), F.lit(None).cast("string").alias("notes"))
