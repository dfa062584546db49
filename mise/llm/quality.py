"""Quality rules as a short-circuit cascade, in DataFrame functions alone.

Each rule rejects a text.  A text is kept if no rule rejects it, so the order of the rules never
changes the verdict, only its cost.  The order is chosen on a bounded sample: each rule's time and
the texts it rejects among those still standing give rejections per second; the best goes first,
and the next is chosen for what is left.  The cascade is one CASE WHEN, whose later branches are
not evaluated for a text that an earlier one rejects.

Defined results: a null text is an empty text, which has no words and is rejected; repeated rows
get the same verdict each; other columns are carried through unchanged, whatever their names; an
empty table gives an empty table (the rules then keep their listed order).
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import NOT_BLANK, let, text_words, whole_text

#: Rows the order of the rules is estimated on, at most.
SAMPLE_ROWS = 200
#: Each rule is timed so often on the sample; the least time counts, as the others hold more of Spark's own.
COST_RUNS = 3
SYMBOLS = r"#*$%&|<>"


# ------------------------------------------------------------------------------------- measures
def count_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", ""))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(NOT_BLANK))


def count_duplicate_lines(lines: Column) -> Column:
    """Lines equal to an earlier one."""
    return F.size(lines) - F.size(F.array_distinct(lines))


#: Low bits of a window's sort key hold its position, the others a hash of its words.
POSITION_BITS = 30


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def _covered(positions: Column, width: int) -> Column:
    """Words covered by windows that start at these ascending positions."""
    def gain(ps, p, i):
        return F.when(i < F.size(ps) - 1, F.least(F.lit(width), ps[F.least(i + 1, F.size(ps) - 1)] - p)).otherwise(width)

    return let(positions, lambda ps: _sum(F.transform(ps, lambda p, i: gain(ps, p, i))))


def count_repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text.

    Windows are sorted as longs of hash and position.  Neighbours with the same hash are compared
    word by word; if one such pair differs (a collision), the text's windows are sorted as strings
    instead.
    """
    mask = (1 << POSITION_BITS) - 1

    def windows(w: Column) -> Column:
        n = F.size(w) - 2
        return F.arrays_zip(F.slice(w, 1, n), F.slice(w, 2, n), F.slice(w, 3, n))

    def key(window: Column, i: Column) -> Column:
        return F.xxhash64(window).bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))

    def place(k: Column) -> Column:
        return k.bitwiseAND(F.lit(mask)).cast("int")

    def same_words(w: Column, p: Column, q: Column) -> Column:
        return (w[p] == w[q]) & (w[p + 1] == w[q + 1]) & (w[p + 2] == w[q + 2])

    def like_next(xs: Column, same) -> Column:
        """Indexes of the elements of sorted xs that equal the next one."""
        return F.when(F.size(xs) > 1, F.filter(F.sequence(F.lit(0), F.size(xs) - 2), lambda i: same(xs[i], xs[i + 1]))
                      ).otherwise(F.array().cast("array<int>"))

    def covered(pairs: Column) -> Column:
        return _covered(F.sort_array(F.array_distinct(F.flatten(pairs))), 3)

    def by_strings(w: Column) -> Column:
        strings = F.sort_array(F.transform(windows(w), lambda z, i: F.struct(z.alias("g"), i.alias("p"))))
        return let(strings, lambda s: covered(F.transform(
            like_next(s, lambda a, b: a["g"] == b["g"]), lambda i: F.array(s[i]["p"], s[i + 1]["p"]))))

    def by_hashes(w: Column, keys: Column) -> Column:
        found = like_next(keys, lambda a, b: F.shiftright(a.bitwiseXOR(b), POSITION_BITS) == 0)
        return let(F.transform(found, lambda i: F.array(place(keys[i]), place(keys[i + 1]))), lambda pairs: F.when(
            F.exists(pairs, lambda x: ~same_words(w, x[0], x[1])), by_strings(w)).otherwise(covered(pairs)))

    return let(words, lambda w: F.when(F.size(w) >= 3, let(
        F.sort_array(F.transform(windows(w), key)), lambda keys: by_hashes(w, keys))).otherwise(0))


def base_measures(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words."""
    def of_words(t: Column, w: Column) -> Column:
        return let(lines_with_words(t), lambda lines: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            count_symbols(t).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            count_duplicate_lines(lines).cast("long").alias("n_dup_lines"),
            count_repeated_words(w).cast("long").alias("n_repeat_words")))

    return let(text, lambda t: let(text_words(t), lambda w: of_words(t, w)))


# ---------------------------------------------------------------------------------------- rules
@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a text that the rule rejects, never null."""

    name: str
    rejects: Column


#: Limits of the default rules.
MIN_WORDS, MAX_REPEAT_PERCENT, MAX_SYMBOL_PERCENT, MAX_DUP_LINE_PERCENT = 50, 50, 20, 50
MIN_MEAN_WORD, MAX_MEAN_WORD, MAX_ELLIPSIS_PERCENT = 2, 15, 30


def default_rules(text: Column) -> list[Rule]:
    """Rules on a text column, each computing only what it needs."""
    n_words = F.size(text_words(text))
    ellipsis = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"(?:\.\.\.|…)\s*$"))
    return [
        Rule("few_words", n_words < MIN_WORDS),
        Rule("repeated_words", let(text_words(text), lambda w: 100 * count_repeated_words(w) > MAX_REPEAT_PERCENT * F.size(w))),
        Rule("symbols", 100 * count_symbols(text) > MAX_SYMBOL_PERCENT * n_words),
        Rule("duplicate_lines", let(lines_with_words(text), lambda x: 100 * count_duplicate_lines(x) > MAX_DUP_LINE_PERCENT * F.size(x))),
        Rule("word_length", let(text_words(text), lambda w: ~F.length(F.array_join(w, "")).between(
            MIN_MEAN_WORD * F.size(w), MAX_MEAN_WORD * F.size(w)))),
        Rule("ellipsis", let(lines_with_words(text), lambda x: 100 * F.size(ellipsis) > MAX_ELLIPSIS_PERCENT * F.size(x))),
    ]


def measured_rules(m: Column, text: Column) -> list[Rule]:
    """The default rules on the struct of :func:`base_measures`, for results that hold the measures too."""
    n = m["n_words"]
    return [
        Rule("few_words", n < MIN_WORDS),
        Rule("repeated_words", 100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * n),
        Rule("symbols", 100 * m["n_symbols"] > MAX_SYMBOL_PERCENT * n),
        Rule("duplicate_lines", 100 * m["n_dup_lines"] > MAX_DUP_LINE_PERCENT * m["n_lines"]),
        Rule("word_length", ~m["word_chars"].between(MIN_MEAN_WORD * n, MAX_MEAN_WORD * n)),
        default_rules(text)[-1],
    ]


# -------------------------------------------------------------------------------------- cascade
def rule_costs(sample: DataFrame, rules: Sequence[Rule]) -> dict[str, float]:
    """Seconds each rule takes on the sample beyond reading it."""
    def seconds(df: DataFrame) -> float:
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    def least(df: DataFrame) -> float:
        return min(seconds(df) for _ in range(COST_RUNS))

    plain = least(sample)
    return {r.name: max(1e-3, least(sample.select(r.rejects)) - plain) for r in rules}


def rule_order(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second among what the rules before them leave, on a bounded
    sample: the texts of least hash, wherever they stand.  The sample only orders the rules; every text goes through all
    that it reaches."""
    # Driver-side: at most 2 ** len(rules) groups, of at most sample_rows texts.
    text = whole_text(docs.columns[0])
    sample = cut_lineage(docs.orderBy(F.xxhash64(text)).limit(sample_rows))
    costs = rule_costs(sample, rules)
    groups = sample.select(*[r.rejects.alias(f"r{i}") for i, r in enumerate(rules)])
    groups = groups.groupBy(*groups.columns).count().collect()
    left, order = list(range(len(rules))), []
    while left:
        def gain(i: int, groups=groups) -> tuple[float, float]:
            return sum(g["count"] for g in groups if g[f"r{i}"]) / costs[rules[i].name], -costs[rules[i].name]

        best = max(left, key=gain)
        order.append(rules[best])
        left.remove(best)
        groups = [g for g in groups if not g[f"r{best}"]]
    return order


def cascade(rules: Sequence[Rule]) -> Column:
    """True if no rule rejects; a rule is evaluated only if those before it don't reject."""
    kept = F.lit(True)
    for r in reversed(rules):
        kept = F.when(r.rejects, F.lit(False)).otherwise(kept)
    return kept


def keep_good(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows whose text passes the cascade; columns as given."""
    rules = default_rules(whole_text(text_col))
    return docs.filter(cascade(rule_order(docs.select(text_col), rules, sample_rows)))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per input row: id, measures, ``base_failed`` (few or repeated words) and ``kept``."""
    text = whole_text(text_col)
    names = [r.name for r in rule_order(docs.select(text_col), default_rules(text), sample_rows)]
    m = F.col("m")
    measured = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"), base_measures(text).alias("m"))
    rules = {r.name: r for r in measured_rules(m, whole_text("t"))}
    return measured.select(
        "doc_id", m["n_words"].alias("n_words"), m["word_chars"].alias("word_chars"), m["n_symbols"].alias("n_symbols"),
        m["n_dup_lines"].alias("n_dup_lines"), m["n_repeat_words"].alias("n_repeat_words"),
        (rules["few_words"].rejects | rules["repeated_words"].rejects).alias("base_failed"),
        cascade([rules[n] for n in names]).alias("kept"))
