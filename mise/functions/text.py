"""Line-level text functions.

All functions build native Spark column expressions (regexp, split, higher-order functions):
they run inside the JVM, per row, with no Python per row and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicon as lx

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


WHITESPACE = " \t\n\r\f\u000b"


def js_trim(c: ColumnOrName) -> Column:
    """Trim all surrounding whitespace (tabs and newlines too, unlike Spark's one-argument ``trim``)."""
    return F.trim(col(c), F.lit(WHITESPACE))


def lines_of(c: ColumnOrName) -> Column:
    """Split text on newlines, keeping empty lines (positions matter for the section scan)."""
    return F.split(col(c), "\n", -1)


def first_match(text: ColumnOrName, patterns: Sequence[str], group: int = 1) -> Column:
    """Group ``group`` of the first pattern that matches, else NULL (ordered regex cascade).  A pattern with words that it
    needs (``lexicon.NEEDED``) is tried where one of them stands."""
    def one(t: Column, p: str) -> Column:
        found = let(F.regexp_extract(t, p, group), lambda m: F.when(m != "", m))
        return F.when(contains_any(t, lx.NEEDED[p]), found) if p in lx.NEEDED else found

    return let(col(text), lambda t: F.coalesce(*[one(t, p) for p in patterns]))


def contains_any(text: ColumnOrName, words: Sequence[str]) -> Column:
    t = col(text)
    out = None
    for w in words:
        c = t.contains(w)
        out = c if out is None else (out | c)
    return out if out is not None else F.lit(False)


# ------------------------------------------------------------------------------------------ B1
def decode_json_array_col(c: ColumnOrName) -> Column:
    """Parse a JSON array of strings; an invalid cell becomes a one-element array of its text."""
    c = col(c)
    return F.coalesce(F.from_json(c, "array<string>"), F.array(c))


def decode_json_array(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or column, decode_json_array_col(column))


# ------------------------------------------------------------------------------------- B2 / B3
def _header_tag(line: Column, headers: Sequence[tuple[str, str]], marks: str) -> Column:
    return _tag_of(F.regexp_replace(F.lower(line), marks, ""), headers)


def _tag_of(cleaned: Column, headers: Sequence[tuple[str, str]]) -> Column:
    """The header that a line in lower case, without marks, is."""
    def of(c: Column) -> Column:
        tag = None
        for name, pattern in headers:
            cond = c.rlike(pattern)
            tag = F.when(cond, F.lit(name)) if tag is None else tag.when(cond, F.lit(name))
        return tag

    return let(js_trim(cleaned), of)


DEFAULT_HEADERS = (("ingredients", lx.INGREDIENT_HEADER), ("instructions", lx.INSTRUCTION_HEADER))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: a lambda variable keeps its value, where
    a column used several times may be computed as often."""
    return F.get(F.transform(F.array(value), body), 0)


#: Lengths are summed block by block, so that an offset costs about the same at the end of a long text.
OFFSET_BLOCK = 256


def offsets(lengths: Column) -> Column:
    """For an array of integers, what the elements before each one add up to."""
    block = F.lit(OFFSET_BLOCK)

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0), lambda a, x: a + x)

    def of(xs: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / block).cast("int"))
        sums = F.transform(blocks, lambda b: total(F.slice(xs, b * block + 1, block)))
        return let(sums, lambda ss: let(F.transform(ss, lambda _, b: total(F.slice(ss, F.lit(1), b))), lambda before: F.transform(
            xs, lambda _, i: before[F.floor(i / block).cast("int")] + total(F.slice(xs, i - i % block + 1, i % block)))))

    return let(lengths, lambda xs: F.when(F.size(xs) > 0, of(xs)).otherwise(F.array().cast("array<int>")))


def _segments(lines: Column, cleaned: Column, headers: Sequence[tuple[str, str]]) -> Column:
    """Runs of lines between headers as array of (name, start, len); 'general' before the first.  ``cleaned``: the same
    lines in lower case, without marks."""
    found = F.filter(F.transform(cleaned, lambda l, i: F.struct(i.alias("pos"), _tag_of(l, headers).alias("name"))),
                     lambda h: h["name"].isNotNull())

    def end(hs: Column, k) -> Column:
        return F.coalesce(F.get(hs, k)["pos"], F.size(lines))

    def segment(name: Column, start: Column, stop: Column) -> Column:
        return F.struct(name.alias("name"), start.alias("start"), (stop - start).alias("len"))

    return let(found, lambda hs: F.concat(F.array(segment(F.lit("general"), F.lit(0), end(hs, F.lit(0)))),
                                           F.transform(hs, lambda h, k: segment(h["name"], h["pos"] + 1, end(hs, k + 1)))))


def _lines_in(lines: Column, segments: Column, name: str) -> Column:
    return F.flatten(F.transform(F.filter(segments, lambda s: (s["name"] == name) & (s["len"] > 0)),
                                 lambda s: F.slice(lines, s["start"] + 1, s["len"])))


def _with_tails(lines: Column, headers: Sequence[tuple[str, str]], marks: str) -> Column:
    """Lines with a header line followed by what stands behind its colon, if anything does."""
    def one(line: Column) -> Column:
        tail = js_trim(F.regexp_replace(F.regexp_extract(line, r"(?s)^[^:]*:(.*)$", 1), r"^[*#_\s]+|[*#_\s]+$", ""))
        return F.when(_header_tag(line, headers, marks).isNotNull() & (tail != ""), F.array(line, tail)).otherwise(F.array(line))

    return F.flatten(F.transform(lines, one))


def split_sections_col(text: ColumnOrName, headers: Sequence[tuple[str, str]] = DEFAULT_HEADERS,
                       detect: bool = True, marks: str = lx.HEADER_MARKS, keep_header_tail: bool = False) -> Column:
    """struct<general, ingredients, instructions> of line arrays (B2, with B3 when ``detect``).

    A header line switches the section and is itself dropped; with ``keep_header_tail`` what follows
    its colon ("Step 1: mix") is the section's next line.  Headers are found in one pass, and
    each section is cut out between them, so the work grows with the lines."""
    def of(lines: Column, segments: Column) -> Column:
        general, ingredients, instructions = (_lines_in(lines, segments, n) for n in ("general", "ingredients", "instructions"))
        if detect:
            ingredients, instructions = detect_sections_cols(lines, ingredients, instructions)
        return F.struct(general.alias("general"), ingredients.alias("ingredients"), instructions.alias("instructions"))

    if keep_header_tail:
        return let(_with_tails(lines_of(text), headers, marks), lambda lines: let(
            F.transform(lines, lambda l: F.regexp_replace(F.lower(l), marks, "")),
            lambda cleaned: let(_segments(lines, cleaned, headers), lambda segments: of(lines, segments))))
    # The whole text is put in lower case and freed of marks before it is cut: no mark is a line end.
    low = F.lower(col(text))
    if marks == lx.HEADER_MARKS:
        bare = low
        for mark in lx.HEADER_MARK_CHARS:
            bare = F.replace(bare, F.lit(mark), F.lit(""))
    else:
        bare = F.array_join(F.transform(lines_of(low), lambda l: F.regexp_replace(l, marks, "")), "\n")
    return let(lines_of(text), lambda lines: let(_segments(lines, lines_of(bare), headers), lambda segments: of(lines, segments)))


def detect_sections_cols(lines: Column, ingredients: Column, instructions: Column):
    """When no section was found, measure-like lines are ingredients, verb-initial ones steps."""
    none_found = (F.size(ingredients) == 0) & (F.size(instructions) == 0)
    measure = F.filter(lines, lambda l: js_trim(l).rlike(lx.MEASURE_LINE))
    verbs = F.filter(lines, lambda l: let(js_trim(l), lambda t: t.rlike(lx.VERB_LINE) & ~t.rlike(lx.MEASURE_LINE)))
    return (F.when(none_found, measure).otherwise(ingredients),
            F.when(none_found, verbs).otherwise(instructions))


def split_sections(df: DataFrame, text: str, out: str = "sections",
                   headers: Sequence[tuple[str, str]] = DEFAULT_HEADERS, detect: bool = True, keep_header_tail: bool = False) -> DataFrame:
    return df.withColumn(out, split_sections_col(text, headers, detect, keep_header_tail=keep_header_tail))


def detect_sections(df: DataFrame, text: str, out: str = "sections") -> DataFrame:
    """B3 on its own: classify every line of a header-less text."""
    lines = lines_of(text)
    empty = F.array().cast("array<string>")
    ing, ins = detect_sections_cols(lines, empty, empty)
    return df.withColumn(out, F.struct(ing.alias("ingredients"), ins.alias("instructions")))


# ------------------------------------------------------------------------------------------ B7
def _strip_marks(c: Column) -> Column:
    def stars(x: Column) -> Column:
        x = F.regexp_replace(x, r"\*\*(.*?)\*\*", "$1")
        return F.regexp_replace(x, r"\*(.*?)\*", "$1")

    def of(x: Column) -> Column:
        marked = F.regexp_replace(F.regexp_replace(stars(x), r"~~(.*?)~~", "$1"), r"^\*+|\*+$", "")
        return F.when(x.contains("*") | x.contains("~~"), marked).otherwise(x)

    return let(c, of)


def clean_instruction_line(line: Column, style: str = "post") -> Column:
    """Drop numbering, bullets and emphasis marks; NULL when the result is 10 characters or less."""
    if style == "post":
        def bare(t: Column) -> Column:
            c = F.regexp_replace(F.regexp_replace(t, r"^\d+\.?\s*", ""), r"^[*\-+•]\s*", "")
            return let(js_trim(_strip_marks(c)), lambda c: F.when(F.length(c) > 10, c))

        return let(js_trim(line), lambda t: F.when(F.length(t) >= 10, bare(t)))
    return let(js_trim(_strip_marks(F.regexp_replace(line, r"^\d+\.?\s*", ""))), lambda c: F.when(F.length(c) > 10, c))


def clean_instructions_col(lines: ColumnOrName, style: str = "post") -> Column:
    cleaned = F.transform(col(lines), lambda l: clean_instruction_line(l, style))
    return F.filter(cleaned, lambda x: x.isNotNull())


def clean_instructions(df: DataFrame, lines: str, out: str | None = None, style: str = "post") -> DataFrame:
    return df.withColumn(out or lines, clean_instructions_col(lines, style))


# ------------------------------------------------------------------------------------------ B8
def description_col(text: ColumnOrName, general: Column | None = None) -> Column:
    """First trimmed line over 30 chars that is not a heading or list item; else the first three
    general-section lines joined, cut to 500 characters."""
    lines = F.transform(lines_of(text), lambda l: js_trim(l))

    def ok(l):
        low = F.lower(l)
        cond = F.length(l) > 30
        for w in lx.DESCRIPTION_EXCLUDES:
            cond = cond & ~low.contains(w)
        return cond & ~l.rlike(r"^\d+\.") & ~l.startswith("**") & ~l.startswith("-")

    first = F.get(F.filter(lines, ok), 0)
    if general is None:
        general = split_sections_col(text)["general"]
    fallback = F.substring(js_trim(F.array_join(F.slice(general, 1, 3), " ")), 1, 500)
    return F.coalesce(first, F.nullif(fallback, F.lit("")))


def extract_description(df: DataFrame, text: str, out: str = "description") -> DataFrame:
    return df.withColumn(out, description_col(text))


# ----------------------------------------------------------------------------------- B28 - B30
def render_text_col(arr: ColumnOrName) -> Column:
    """Numbered text: '1. first\\n2. second'."""
    return F.array_join(F.transform(col(arr), lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")


def render_text(df: DataFrame, arr: str, out: str = "text") -> DataFrame:
    return df.withColumn(out, render_text_col(arr))


def split_list_col(c: ColumnOrName) -> Column:
    """Split a user list on comma, semicolon, pipe or newline; trim; drop empties."""
    return F.filter(F.transform(F.split(col(c), r"[,;|\n]"), lambda x: js_trim(x)), lambda x: x != "")


def split_list(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or column, split_list_col(column))


def ingredient_label(ing: Column) -> Column:
    """'quantity unit name' with missing parts left out."""
    return js_trim(F.concat_ws(" ", ing["quantity"].cast("string"), ing["unit"], ing["name"]))


def ingredient_labels(df: DataFrame, ingredients: str = "ingredients", out: str = "labels") -> DataFrame:
    return df.withColumn(out, F.transform(F.col(ingredients), ingredient_label))
