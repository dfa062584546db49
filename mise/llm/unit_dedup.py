"""Substring dedup by hashing lines, or the sentences within them.

Each unit is normalised (lower case, runs of anything but letters and digits as one space) and
hashed to 128 bits.  Equal digests are grouped over all documents; the occurrence that ranks first
(lowest document id, then text, then offset) stays, and every other one is removed.  Offsets refer
to the original text in code points, end exclusive, so that any result can be traced back.

Digests are aggregated before and after the shuffle, so a unit that most documents hold is one row
per task.  Its occurrences then meet that row in a join that Spark may split at will.

With ``min_words`` None no unit is passed by for its length.  A unit that is a line counts as it is.
A sentence inside a line that chance may repeat (fewer than MIN_WORDS words and than CHANCE_CHARS
characters) counts together with the unit before it, and with the one after it: it goes if either
pair has an earlier occurrence, so that a repeated run of sentences goes as a whole.  Sentences then
also end at the signs of scripts that put no space after them.

Defined results: a null text is empty and has no units; a document without id ranks before those
with one; repeated rows (same id and text) are one document, so none removes units from the other;
units of fewer words than asked for are left alone; an empty table gives an empty result; cleaning
carries other columns through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, let, running_sums, whole_text, without_spans

MIN_WORDS = 6
#: The space after a sentence's last sign.
SENTENCE_END = r"\x20(?<=[.!?]\x20)"
#: The place after a sentence's last sign, in scripts without spaces.
SIGN_END = "(?<=[。！？｡])(?![。！？｡」』”’）])"
#: Sentences inside a line with fewer characters than this may be repeated by chance.
CHANCE_CHARS = 16


def _pieces(text: Column, pattern: str, gap: int = 1) -> Column:
    """Array of (s, t): what lies between separators of ``gap`` characters, with offsets."""
    return let(F.split(text, pattern, -1), lambda xs: let(
        running_sums(F.transform(xs, lambda x: F.length(x) + gap)),
        lambda before: F.transform(xs, lambda x, i: F.struct(before[i].alias("s"), x.alias("t")))))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def text_units(docs: DataFrame, unit: str, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """One row per unit: doc_id, text_hash, start, end and the digest (h1, h2)."""
    if unit not in ("line", "sentence"):
        raise ValueError(f"unit must be line or sentence, not {unit!r}")
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       F.explode(_pieces(text, "\n")).alias("line"))
    rows = rows.select("doc_id", "text_hash", F.col("line.s").alias("start"), F.col("line.t").alias("unit"))
    if unit == "sentence":
        rows = rows.select("doc_id", "text_hash", "start", F.explode(_pieces(F.col("unit"), SENTENCE_END)).alias("x"))
        rows = rows.select("doc_id", "text_hash", (F.col("start") + F.col("x.s")).alias("start"), F.col("x.t").alias("unit"))
    rows = rows.select("doc_id", "text_hash", "start", (F.col("start") + F.length("unit")).alias("end"),
                       normalised(F.col("unit")).alias("norm"))
    # A unit of n words has n - 1 spaces.
    rows = rows.where(F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit(""))) >= min_words - 1).where("norm != ''")
    return rows.select("doc_id", "text_hash", "start", "end", F.xxhash64("norm").alias("h1"),
                       F.xxhash64(F.lit(1), F.col("norm")).alias("h2"))


def _within(units: Column, pattern: str, gap: int) -> Column:
    """Units (s, t) cut further, offsets as before."""
    return F.flatten(F.transform(units, lambda u: F.transform(_pieces(u["t"], pattern, gap), lambda x: F.struct(
        (u["s"] + x["s"]).alias("s"), x["t"].alias("t")))))


def all_units(docs: DataFrame, unit: str, id_col: str, text_col: str) -> DataFrame:
    """One row per unit of any length, or two or three with what it counts with: columns of ``text_units`` and ``alone``,
    false if the digest is of more than the unit."""
    if unit not in ("line", "sentence"):
        raise ValueError(f"unit must be line or sentence, not {unit!r}")
    text = whole_text(text_col)

    def parts(line: Column) -> Column:
        one = F.array(line)
        cut = one if unit == "line" else F.when(line["t"].rlike(f"{SENTENCE_END}|{SIGN_END}"), _within(
            _within(one, SENTENCE_END, 1), SIGN_END, 0)).otherwise(one)
        return let(F.filter(F.transform(cut, lambda u: F.struct(
            u["s"].alias("s"), (u["s"] + F.length(u["t"])).alias("e"), normalised(u["t"]).alias("n"))), lambda u: u["n"] != ""),
            lambda xs: F.transform(xs, lambda u: F.struct(u["s"].alias("s"), u["e"].alias("e"), u["n"].alias("n"),
                                                          (F.size(xs) == 1).alias("line"))))

    units = F.flatten(F.transform(_pieces(text, "\n"), parts))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), units.alias("u"))
    # Neighbours are taken over lines.
    rows = rows.select("doc_id", "text_hash", F.explode(F.transform("u", lambda u, i: F.struct(
        u["s"].alias("start"), u["e"].alias("end"), u["n"].alias("norm"), u["line"].alias("line"),
        F.when(i > 0, F.get(F.col("u"), i - 1)["n"]).alias("before"), F.get(F.col("u"), i + 1)["n"].alias("after")))).alias("x"))
    rows = rows.select("doc_id", "text_hash", "x.*")
    words = F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit(""))) + 1
    chance = (words < MIN_WORDS) & (F.length("norm") < CHANCE_CHARS)
    none = F.lit(None).cast("string")

    def keyed(kind: int, before: Column, after: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), before.alias("b"), after.alias("a"))

    # Kind 0 counts wherever it stands, 1 as a line, 2 and 3 with a neighbour.
    keys = F.when(~chance, F.array(keyed(0, none, none))).otherwise(F.filter(F.array(
        F.when(F.col("line"), keyed(1, none, none)), F.when(F.col("before").isNotNull(), keyed(2, F.col("before"), none)),
        F.when(F.col("after").isNotNull(), keyed(3, none, F.col("after")))), lambda k: k.isNotNull()))
    rows = rows.select("doc_id", "text_hash", "start", "end", "norm", F.explode(keys).alias("k"))

    def digest(seed: int) -> Column:
        of = [F.lit(seed)] if seed else []
        return F.when(F.col("k.kind") == 0, F.xxhash64(*of, F.col("norm"))).otherwise(
            F.xxhash64(*of, F.col("k.kind"), F.coalesce("k.b", F.lit("")), F.col("norm"), F.coalesce("k.a", F.lit(""))))

    return rows.select("doc_id", "text_hash", "start", "end", digest(0).alias("h1"), digest(1).alias("h2"),
                       (F.col("k.kind") == 0).alias("alone"))


def repeated_units(docs: DataFrame, unit: str = "line", min_words: int | None = MIN_WORDS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per removed occurrence: doc_id, text_hash, start, end, and doc_id and start of the one that stays."""
    if min_words is None:
        # Cut once, read several times.
        scratch = Scratch(docs.sparkSession)
        units = scratch.table(all_units(docs, unit, id_col, text_col))
    else:
        units = text_units(docs, unit, min_words, id_col, text_col).withColumn("alone", F.lit(True))
    place = F.struct("doc_id", "text_hash", "start")
    kept = units.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    kept = kept.where(~F.col("first").eqNullSafe(F.col("last"))).select("h1", "h2", "first")
    if min_words is None:
        kept = scratch.table(kept)
    found = units.join(kept, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    columns = ["doc_id", "text_hash", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"),
               F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").cast("long").alias("first_start")]
    if min_words is not None:
        return found.select(*columns)
    # What was found by several keys is one removal.
    paired = found.where(~F.col("alone")).groupBy("doc_id", "text_hash", "start", "end").agg(F.min("first").alias("first"))
    return found.where("alone").select(*columns).unionByName(paired.select(*columns))


def remove_repeated_units(docs: DataFrame, unit: str = "line", min_words: int | None = MIN_WORDS, id_col: str = "doc_id",
                          text_col: str = "text", spans_col: str = "removed_spans") -> DataFrame:
    """The documents without their repeated units, other columns as given, and ``spans_col``: the
    removed offsets in the original text (array of s, e)."""
    if spans_col in docs.columns:
        raise ValueError(f"the table has a column {spans_col!r}; give another spans_col")
    found = repeated_units(docs, unit, min_words, id_col, text_col)
    # At most the units of one text in a group.
    found = found.groupBy(F.col("doc_id").alias("_k1"), F.col("text_hash").alias("_k2")).agg(F.sort_array(F.collect_set(
        F.struct(F.col("start").cast("int").alias("s"), F.col("end").cast("int").alias("e")))).alias("_sp"))
    spans = F.coalesce(found["_sp"], F.array().cast("array<struct<s:int,e:int>>"))
    joined = docs.join(found, docs[id_col].eqNullSafe(found["_k1"]) & (F.xxhash64(whole_text(docs[text_col])) == found["_k2"]), "left")
    keep = [F.when(docs[c].isNotNull(), without_spans(docs[c], spans)).alias(c) if c == text_col else docs[c] for c in docs.columns]
    return joined.select(*keep, spans.alias(spans_col))
