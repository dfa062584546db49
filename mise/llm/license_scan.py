"""Licence scans by Dice coefficient over word bigrams, in DataFrame functions alone.

Units of a text are its lines, its paragraphs (between empty lines), runs of paragraphs and the whole
of it.  A unit is normalised to lower-case runs of letters and digits; its Dice coefficient with a
template is twice the number of bigrams in both over the sum of their numbers.  A coefficient of t
needs sizes within a factor of (2 - t) / t of each other, so each unit meets only the templates of
about its size.

A licence in its usual layout has several paragraphs.  A run is two or more paragraphs in a row,
those without words aside, whose first and last have at least LEAST_SHARE of their bigrams in some
template, and which has no more than REPEATS times the words of the largest size bound.  (Were fewer
of an end's bigrams in the template, the run would mostly score higher without that end.)  Of
overlapping runs, paragraphs and whole texts that match, only a run that none of them beats is reported.

Few texts need this at all.  A unit that reaches t misses at most a known number of a template's
bigrams, so it holds a word of any set of words that touches more of them than that.  Such a set is
chosen for all templates together, and texts without any of its words are passed by.

Templates are a fixed list, held as a literal: nothing is joined or shuffled.

Defined results: a null text has no units; offsets count code points, end exclusive; of a unit's
templates the one with the highest coefficient is reported, then the first in the list; equal spans
are reported once, as the smallest unit; repeated rows are reported each; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, running_sums
from .license_texts import TEMPLATES

#: In hundredths, so that comparisons are exact.
LEAST_DICE = 75
#: Bigrams of a run's first and last paragraphs that templates have, in hundredths.
LEAST_SHARE = 35
#: Words of a run for each bigram of the largest size bound: bigrams count once however often they come.
REPEATS = 2


@dataclass(frozen=True)
class Template:
    license_id: str
    bigrams: tuple[str, ...]


def plain_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def templates(texts: Sequence[tuple[str, str]] = TEMPLATES) -> list[Template]:
    out = []
    for license_id, text in texts:
        w = plain_words(text)
        out.append(Template(license_id, tuple(sorted({f"{a} {b}" for a, b in zip(w, w[1:])}))))
    return out


def size_bounds(n: int, least: int) -> tuple[int, int]:
    """Bigrams a unit may have to reach the coefficient with a template of n."""
    return -(-n * least // (200 - least)), n * (200 - least) // least


#: Words of ordinary texts, markers only where no other word will do.
COMMON = frozenset("a all an and any as be both by copy either for free from in is it may not of on or other out shall source "
                   "that the this to under use who will with without work you your 0 1 2 3 4 v".split())


def marker_words(known: Sequence[Template], least: int) -> list[str]:
    """Words of which any unit that reaches the coefficient with some template holds one."""
    # A unit of x bigrams shares at least least (x + n) / 200; fewest at the smallest size.
    need = [len(t.bigrams) + 1 - -(-least * (size_bounds(len(t.bigrams), least)[0] + len(t.bigrams)) // 200) for t in known]
    touched: list[set[str]] = [set() for _ in known]
    chosen: list[str] = []
    words = sorted({w for t in known for b in t.bigrams for w in b.split()})
    while any(len(x) < n for x, n in zip(touched, need)):
        def gain(w: str) -> tuple[int, int]:
            return sum(min(n - len(x), sum(w in b.split() and b not in x for b in t.bigrams))
                       for t, x, n in zip(known, touched, need) if len(x) < n), len(w)

        best = max((w for w in words if w not in chosen), key=lambda w: (w not in COMMON and gain(w)[0] > 0, *gain(w), w))
        chosen.append(best)
        for t, x in zip(known, touched):
            x.update(b for b in t.bigrams if best in b.split())
    return chosen


# ----------------------------------------------------------------------------------------- units
def _split_units(text: Column, kind: int) -> Column:
    """Lines (kind 0), paragraphs (1) or the whole text (2) as array of (s, e, kind, t)."""
    def of(parts: Column, gaps: Column) -> Column:
        steps = F.transform(parts, lambda p, i: F.length(p) + F.length(F.coalesce(F.get(gaps, i), F.lit(""))))
        return let(running_sums(steps), lambda at: F.transform(parts, lambda p, i: F.struct(
            at[i].alias("s"), (at[i] + F.length(p)).alias("e"), F.lit(kind).alias("kind"), p.alias("t"))))

    if kind == 2:
        return F.array(F.struct(F.lit(0).alias("s"), F.length(text).alias("e"), F.lit(2).alias("kind"), text.alias("t")))
    pattern = "\n" if kind == 0 else r"\n[\x20\t\r]*\n"
    gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(F.struct(F.split(text, pattern, -1).alias("p"), gaps.alias("g")), lambda x: of(x["p"], x["g"]))


def _words(text: Column) -> Column:
    """Words of a text; one that is empty if there are none."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ", -1)


def _bigrams_of(w: Column) -> Column:
    return F.when(F.size(w) > 1, F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat_ws(" ", w[i], w[i + 1])))).otherwise(
        F.array().cast("array<string>"))


def _bigrams(text: Column) -> Column:
    return let(_words(text), _bigrams_of)


def run_words(known: Sequence[Template]) -> tuple[int, int]:
    """Least and most words of a run."""
    bounds = [size_bounds(len(t.bigrams), LEAST_DICE) for t in known]
    return min(lo for lo, _ in bounds) + 1, REPEATS * max(hi for _, hi in bounds)


def _runs(text: Column, known: Sequence[Template]) -> Column:
    """Runs of paragraphs (kind 3) as array of (s, e, kind, t)."""
    fewest, most = run_words(known)
    listed = sorted({b for t in known for b in t.bigrams})

    def worded(p: Column) -> Column:
        def of(w: Column) -> Column:
            share = let(_bigrams_of(w), lambda b: (F.size(b) > 0) & (100 * F.size(F.filter(b, lambda x: x.isin(listed))) >= LEAST_SHARE * F.size(b)))
            return F.struct(p["s"].alias("s"), p["e"].alias("e"), F.when(w[0] != "", F.size(w)).otherwise(0).alias("n"), share.alias("end"))

        return let(_words(p["t"]), of)

    def of(ps: Column, before: Column) -> Column:
        def from_(p: Column, i: Column) -> Column:
            # Each paragraph has a word, so no more of them than words can follow.
            last = F.least(F.size(ps) - 1, i + most)
            ends = F.filter(F.sequence(i + 1, last), lambda j: ps[j]["end"] & (before[j] + ps[j]["n"] - before[i]).between(fewest, most))
            runs = F.transform(ends, lambda j: F.struct(p["s"].alias("s"), ps[j]["e"].alias("e"), F.lit(3).alias("kind"),
                                                        text.substr(p["s"] + 1, ps[j]["e"] - p["s"]).alias("t")))
            return F.when(p["end"] & (i + 1 < F.size(ps)), runs).otherwise(none)

        return F.flatten(F.transform(ps, from_))

    none = F.array().cast("array<struct<s:int,e:int,kind:int,t:string>>")
    paragraphs = F.filter(F.transform(_split_units(text, 1), worded), lambda p: p["n"] > 0)
    return let(paragraphs, lambda ps: F.when(F.size(F.filter(ps, lambda p: p["end"])) > 1, let(
        running_sums(F.transform(ps, lambda p: p["n"])), lambda before: of(ps, before))).otherwise(none))


def _best(bigrams: Column, known: Column) -> Column:
    """The best template for a unit's bigrams as (dice numerator, denominator, place), or null."""
    n = F.size(bigrams)
    sized = F.filter(known, lambda t: (n >= t["low"]) & (n <= t["high"]))
    scored = F.transform(sized, lambda t: F.struct((2 * F.size(F.array_intersect(t["bigrams"], bigrams))).alias("a"),
                                                   (n + F.size(t["bigrams"])).alias("b"), t["place"].alias("place")))
    good = F.filter(scored, lambda x: 100 * x["a"] >= LEAST_DICE * x["b"])

    def better(x: Column, y: Column) -> Column:
        # Fractions compared crosswise; the list is in order, so the first of equals stays.
        return F.when(x["place"].isNull() | (y["a"] * x["b"] > x["a"] * y["b"]), y).otherwise(x)

    none = F.lit(None).cast("struct<a:int,b:int,place:int>")
    return F.when(F.size(good) > 0, F.aggregate(good, none, better))


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  texts: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per unit that matches a template: doc_id, start, end, license_id and dice."""
    known = templates(texts)
    bounds = [size_bounds(len(t.bigrams), LEAST_DICE) for t in known]
    literal = F.array(*[F.struct(F.lit(lo).alias("low"), F.lit(hi).alias("high"), F.lit(i).alias("place"),
                                 F.array(*map(F.lit, t.bigrams)).alias("bigrams")) for i, (t, (lo, hi)) in enumerate(zip(known, bounds))])
    names = F.array(*[F.lit(t.license_id) for t in known])
    marker = f"(?<![a-z0-9])(?:{'|'.join(marker_words(known, LEAST_DICE))})(?![a-z0-9])"
    least, most = min(b[0] for b in bounds), max(b[1] for b in bounds)

    def marked(text: Column) -> Column:
        return F.lower(text).rlike(marker)

    text = F.col("t")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")).where(marked(text))
    units = let(text, lambda t: F.flatten(F.array(*[_split_units(t, k) for k in (0, 1, 2)], _runs(t, known))))
    units = F.filter(units, lambda u: marked(u["t"]) & (F.length(u["t"]) >= 2 * least))
    scored = F.filter(F.transform(units, lambda u: F.struct(
        u["s"].alias("s"), u["e"].alias("e"), u["kind"].alias("kind"),
        let(_bigrams(u["t"]), lambda b: F.when(F.size(b).between(least, most), _best(b, literal))).alias("m"))),
        lambda x: x["m"].isNotNull())

    def beats(y: Column, x: Column) -> Column:
        """Whether a paragraph, text or run stands against the run x: higher, or as high and no run, or a run further ahead."""
        mine, other = x["m"]["a"] * y["m"]["b"], y["m"]["a"] * x["m"]["b"]
        ahead = (y["kind"] < 3) | (y["s"] < x["s"]) | ((y["s"] == x["s"]) & (y["e"] < x["e"]))
        return (x["kind"] == 3) & (y["kind"] > 0) & (y["s"] < x["e"]) & (x["s"] < y["e"]) & ((other > mine) | ((other == mine) & ahead))

    # A line that is a paragraph or the text is met again there.
    once = let(scored, lambda xs: F.filter(xs, lambda x: ~F.exists(
        xs, lambda y: beats(y, x) | ((y["s"] == x["s"]) & (y["e"] == x["e"]) & (y["kind"] < x["kind"])))))
    hits = rows.select("doc_id", F.explode(once).alias("x"))
    return hits.select("doc_id", F.col("x.s").cast("long").alias("start"), F.col("x.e").cast("long").alias("end"),
                       names[F.col("x.m.place")].alias("license_id"), (F.col("x.m.a") / F.col("x.m.b")).alias("dice"))
