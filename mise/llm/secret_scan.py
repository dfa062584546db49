"""Secret scans: known forms, and windows of high entropy, in DataFrame functions alone.

Known forms are found by pattern, leftmost and non-overlapping for each kind, and dropped if too
short.  The method then adds spans: candidate strings (runs of one character class) are read by a
sliding window whose character counts, and from them its Shannon entropy, change by the character
that enters and the one that leaves.  A candidate's span goes from its first window over the limit
to the end of its last one.  What the allow-list matches is left out of a candidate: the window reads
the characters on both sides of it, which must be secret enough without.  It never drops known forms.

Entropy is compared in whole numbers: H = log2(W) - sum(c log2 c) / W over the counts c of a window
of W characters, so H >= limit means that the sum of rounded(c log2 c x 1e6) is at most a constant.

Defined results: a null text is empty and has no spans; offsets count code points, end exclusive;
repeated rows get the same result each; an empty table gives an empty result; redaction carries
other columns through, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, running_max, running_sums, whole_text, without_spans


@dataclass(frozen=True)
class Form:
    """A known form: matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int
    least: int
    hint: str  # found in every text that has such a match


# Fixed values of the contract, in the order that breaks ties.
FORMS = (
    Form("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8,
         r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}"""),
    Form("access", "AKIA[A-Z0-9]+", 0, 16, "AKIA[A-Z0-9]{12}"),
    Form("hex", "[0-9a-f]+", 0, 32, "[0-9a-f]{32}"),
)


@dataclass(frozen=True)
class CharClass:
    """Candidate strings of one character class: runs of ``chars`` of ``window`` or more that match
    ``mixed``, and the least entropy of a window in bits."""

    kind: str
    chars: str
    alphabet: str
    window: int
    bits: float
    mixed: str


# A run's class must not be met by ordinary long words or numbers: both kinds need letters and digits.
CLASSES = (
    CharClass("hexrun", "[0-9A-Fa-f]", "0123456789abcdefABCDEF", 20, 3.0, "(?=.*[0-9])(?=.*[A-Fa-f])"),
    CharClass("base64", "[A-Za-z0-9+/]", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 24, 3.9,
              "(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"),
    # Without hexadecimal runs, and with digits in two places, as words and names may end in a number.
    CharClass("lowrun", "[0-9a-z]", "0123456789abcdefghijklmnopqrstuvwxyz", 24, 3.6, "(?=.*[g-z])(?=.*[0-9].*[a-z].*[0-9])"),
    # Only with a sign that base64 doesn't have; words joined by hyphens stay under the limit.
    CharClass("urlsafe", "[A-Za-z0-9_-]", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-", 24, 4.1,
              "(?=.*[_-])(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"),
)
KINDS = tuple(f.kind for f in FORMS) + tuple(c.kind for c in CLASSES)

#: Parts of candidates that are not secret: of documentation keys and placeholders.
ALLOW = r"(?i)example|sample|placeholder|changeme|dummy|0123456789|abcdefghij|(.)\1{7}"
#: The same with all of a run of equal characters.
ALLOWED = ALLOW + r"\1*"


def scaled(c: int) -> int:
    """c log2 c in millionths."""
    return round(c * math.log2(c) * 1e6) if c > 1 else 0


def most_scaled(cls: CharClass) -> int:
    """The largest sum over the counts of a window that still has the least entropy."""
    return round(cls.window * (math.log2(cls.window) - cls.bits) * 1e6)


# --------------------------------------------------------------------------------------- spans
def _no_spans() -> Column:
    return F.array().cast("array<struct<s:int,e:int,k:int,m:string>>")


def pattern_matches(text: Column, pattern: str, group: int, kind: int) -> Column:
    """All matches as structs of start, end, kind and the group's text: what lies between the
    matches comes from a split at the pattern, and lengths summed give the offsets."""
    def of(between: Column, found: Column, groups: Column) -> Column:
        steps = F.transform(found, lambda m, i: F.length(between[i]) + F.length(m))
        return let(running_sums(steps), lambda before: F.transform(found, lambda m, i: F.struct(
            (before[i] + F.length(between[i])).alias("s"),
            (before[i] + F.length(between[i]) + F.length(m)).alias("e"),
            F.lit(kind).alias("k"), groups[i].alias("m"))))

    p = F.lit(pattern)
    return let(F.struct(F.split(text, pattern, -1).alias("b"), F.regexp_extract_all(text, p, F.lit(0)).alias("f"),
                        F.regexp_extract_all(text, p, F.lit(group)).alias("g")), lambda x: of(x["b"], x["f"], x["g"]))


def form_spans(text: Column, form: Form) -> Column:
    """Spans of a known form; texts without a hint of one are passed by."""
    found = F.filter(pattern_matches(text, form.pattern, form.group, KINDS.index(form.kind)),
                     lambda x: F.length(x["m"]) >= form.least)
    return F.when(text.rlike(form.hint), found).otherwise(_no_spans())


def unallowed(run: Column, cls: CharClass) -> Column:
    """The characters of a run outside the allow-list's matches, as structs of place in the alphabet and in the run."""
    def chars(piece: Column, start: Column) -> Column:
        return F.transform(F.filter(F.split(piece, "", -1), lambda c: c != ""), lambda c, i: F.struct(
            (F.instr(F.lit(cls.alphabet), c) - 1).alias("c"), (start + i).alias("at")))

    def between(hits: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform(hits, lambda x: x["e"]))
        return let(starts, lambda at: F.flatten(F.transform(F.split(run, ALLOWED, -1), lambda p, i: chars(p, at[i]))))

    return F.when(run.rlike(ALLOW), let(pattern_matches(run, ALLOWED, 0, 0), between)).otherwise(chars(run, F.lit(0)))


def entropy_range(run: Column, cls: CharClass) -> Column:
    """Struct of the first start and the last end, within a run, of windows at or over the limit; -1 if none."""
    w, size = cls.window, len(cls.alphabet)
    table = F.array(*[F.lit(scaled(c)) for c in range(w + 2)])
    most = F.lit(most_scaled(cls))

    def counts_of(codes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(size - 1)),
                           lambda j: F.size(F.filter(F.slice(codes, 1, w), lambda c: c == j)))

    def state(n: Column, total: Column, first: Column, last: Column) -> Column:
        return F.struct(n.alias("n"), total.alias("t"), first.alias("first"), last.alias("last"))

    def judged(n: Column, total: Column, i: Column, first: Column, last: Column) -> Column:
        high = total <= most
        return state(n, total, F.when(high & (first < 0), i).otherwise(first), F.when(high, i + w).otherwise(last))

    def step(codes: Column, acc: Column, i: Column) -> Column:
        # Window i: the character before it leaves, its last one enters.
        out, into = codes[i - 1], codes[i + w - 1]
        n = acc["n"]
        moved = F.transform(n, lambda c, j: c - (j == out).cast("int") + (j == into).cast("int"))
        change = F.when(out == into, F.lit(0)).otherwise(
            table[n[out] - 1] - table[n[out]] + table[n[into] + 1] - table[n[into]])
        return judged(moved, acc["t"] + change, i, acc["first"], acc["last"])

    def of(codes: Column) -> Column:
        def start(n: Column) -> Column:
            total = F.aggregate(F.transform(n, lambda c: table[c]), F.lit(0), lambda a, x: a + x)
            return judged(n, total, F.lit(0), F.lit(-1), F.lit(-1))

        later = F.when(F.size(codes) > w, F.sequence(F.lit(1), F.size(codes) - w)).otherwise(F.array().cast("array<int>"))
        return let(counts_of(codes), lambda n: F.aggregate(
            later, start(n), lambda acc, i: step(codes, acc, i),
            lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last"))))

    def in_run(xs: Column) -> Column:
        none = F.struct(F.lit(-1).alias("first"), F.lit(-1).alias("last"))
        return F.when(F.size(xs) >= w, let(of(F.transform(xs, lambda x: x["c"])), lambda r: F.when(r["last"] > 0, F.struct(
            xs[r["first"]]["at"].alias("first"), (xs[r["last"] - 1]["at"] + 1).alias("last"))).otherwise(none))).otherwise(none)

    return let(unallowed(run, cls), in_run)


def entropy_spans(text: Column, cls: CharClass) -> Column:
    """Spans the sliding window finds in candidate strings of one class."""
    kind = KINDS.index(cls.kind)
    runs = f"{cls.chars}{{{cls.window},}}"
    hint = f"{cls.chars}{{{cls.window}}}"
    candidates = F.filter(pattern_matches(text, runs, 0, kind), lambda x: x["m"].rlike(cls.mixed))
    ranged = F.transform(candidates, lambda x: F.struct(x.alias("x"), entropy_range(x["m"], cls).alias("r")))
    spans = F.transform(F.filter(ranged, lambda y: y["r"]["last"] > 0), lambda y: F.struct(
        (y["x"]["s"] + y["r"]["first"]).alias("s"), (y["x"]["s"] + y["r"]["last"]).alias("e"),
        F.lit(kind).alias("k"), F.lit("").alias("m")))
    return F.when(text.rlike(hint), spans).otherwise(_no_spans())


def _sorted(spans: list[Column]) -> Column:
    """By start, then kind; without the matched texts."""
    places = [F.transform(x, lambda y: F.struct(y["s"].alias("s"), y["k"].alias("k"), y["e"].alias("e"))) for x in spans]
    return F.sort_array(F.concat(*places))


def base_spans(text: Column) -> Column:
    """Spans of the known forms: array of (s, k, e)."""
    return _sorted([form_spans(text, f) for f in FORMS])


def all_spans(text: Column) -> Column:
    """Spans of the known forms and of high entropy."""
    return _sorted([form_spans(text, f) for f in FORMS] + [entropy_spans(text, c) for c in CLASSES])


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", names[x["k"]], x["s"].cast("string"), x["e"].cast("string"))), ",")


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts of the known forms, digest of their spans, and all spans."""
    found = docs.select(F.col(id_col).alias("doc_id"), let(whole_text(text_col), all_spans).alias("spans"))
    base = F.filter("spans", lambda x: x["k"] < len(FORMS))

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["k"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{f.kind}") for k, f in enumerate(FORMS)]
    return found.select("doc_id", *counts, F.sha2(spans_text(base), 256).alias("base_sha256"),
                        spans_text(F.col("spans")).alias("spans"))


MASK = "[secret]"


def _merged(spans: Column) -> Column:
    """Sorted spans with overlapping or touching ones joined: array of (s, e).  A span begins a joined one if it starts
    behind all earlier ends."""
    def of(xs: Column, before: Column) -> Column:
        firsts = F.filter(F.sequence(F.lit(0), F.size(xs) - 1), lambda i: xs[i]["s"] > before[i])

        def upto(fs: Column, g: Column) -> Column:
            last = F.when(g + 1 < F.size(fs), fs[F.least(g + 1, F.size(fs) - 1)] - 1).otherwise(F.size(xs) - 1)
            return F.greatest(before[last], xs[last]["e"])

        return let(firsts, lambda fs: F.transform(fs, lambda i, g: F.struct(xs[i]["s"].alias("s"), upto(fs, g).alias("e"))))

    return F.when(F.size(spans) == 0, F.array().cast("array<struct<s:int,e:int>>")).otherwise(
        let(spans, lambda xs: let(running_max(F.transform(xs, lambda x: x["e"])), lambda before: of(xs, before))))


def redacted(text: Column) -> Column:
    """The text with every span found replaced by MASK; null stays null."""
    return F.when(text.isNotNull(), let(text, lambda t: let(
        _merged(all_spans(t)), lambda spans: without_spans(t, spans, MASK))))


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The rows with their secrets masked, and ``length_col`` (if the table has it) the new length."""
    out = docs.withColumn(text_col, redacted(F.col(text_col)))
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.length(text_col).cast(kind))
    return out
