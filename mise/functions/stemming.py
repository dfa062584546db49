"""The Porter2 English stemmer as staged column expressions.

Each step of the published algorithm is one expression over the word and the starts of its regions R1
and R2.  ``porter2_rows`` makes a projection of each step over a column of words, so all of it runs in
generated code; ``porter2`` is the same for one value, such as an element of an array.  Words are tokens:
lower case, without apostrophes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import let

# Fixed values of the published algorithm.
VOWEL, OTHER = "[aeiouy]", "[^aeiouy]"
R1_WORDS = ("gener", "commun", "arsen")
SPECIAL = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli",
           "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
           "cosmos": "cosmos", "bias": "bias", "andes": "andes"}
SPECIAL_1A = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
DOUBLES = "(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"
SHORT = f"(^{VOWEL}{OTHER}$)|({OTHER}{VOWEL}[^aeiouywxY]$)"
STEP_2 = (("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"), ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"),
          ("lessli", "less"), ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"), ("iviti", "ive"),
          ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"), ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"),
          ("ogi", "og"), ("li", ""))
STEP_2_AFTER = {"ogi": "l$", "li": "[cdeghkmnrt]$"}
STEP_3 = (("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""))
STEP_4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion", "al", "er", "ic")
STEP_4_AFTER = {"ion": "[st]$"}

Step = Callable[[Column, Column, Column], Column]


def marked(word: Column) -> Column:
    """With Y for a y that is a consonant: at the start, or after a vowel."""
    return F.when(word.contains("y"), F.regexp_replace(word, f"(^|{VOWEL})y", "$1Y")).otherwise(word)


def region(word: Column, start: Column | int, first: Sequence[str] = ()) -> Column:
    """Where the region begins: behind the first consonant after a vowel, from ``start`` on; the word's end if there is none."""
    start = F.lit(start) if isinstance(start, int) else start
    found = F.length(F.regexp_extract(word.substr(start + 1, F.length(word)), f"^({'|'.join([*first, f'{OTHER}*{VOWEL}+{OTHER}'])})", 1))
    return F.when(found > 0, start + found).otherwise(F.length(word))


def _less(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _first(cases: Sequence[tuple[Column, Column]], other: Column) -> Column:
    out = None
    for condition, value in cases:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(other)


def _step_1a(w: Column, r1: Column, r2: Column) -> Column:
    return _first([(w.endswith("sses"), _less(w, 2)),
                   (w.endswith("ied") | w.endswith("ies"), F.when(F.length(w) > 4, _less(w, 2)).otherwise(_less(w, 1))),
                   (w.endswith("us") | w.endswith("ss") | ~w.endswith("s"), w), (_less(w, 2).rlike(VOWEL), _less(w, 1))], w)


def _step_1b(w: Column, r1: Column, r2: Column) -> Column:
    """Endings go; what the rest then needs is seen to in the next step, for which it is marked."""
    def without(n: int) -> Column:
        return F.when(_less(w, n).rlike(VOWEL), F.concat(_less(w, n), F.lit("|"))).otherwise(w)

    def shortened(n: int) -> Column:
        return F.when(F.length(w) - n >= r1, F.concat(_less(w, n), F.lit("ee"))).otherwise(w)

    return _first([(w.endswith("eedly"), shortened(5)), (w.endswith("eed"), shortened(3)), (w.endswith("ingly"), without(5)),
                   (w.endswith("edly"), without(4)), (w.endswith("ing"), without(3)), (w.endswith("ed"), without(2))], w)


def _step_1b_rest(w: Column, r1: Column, r2: Column) -> Column:
    rest = _less(w, 1)
    return _first([(~w.endswith("|"), w), (rest.rlike("(at|bl|iz)$"), F.concat(rest, F.lit("e"))), (rest.rlike(DOUBLES), _less(w, 2)),
                   ((F.length(w) - 1 <= r1) & rest.rlike(SHORT), F.concat(rest, F.lit("e")))], rest)


def _step_1c(w: Column, r1: Column, r2: Column) -> Column:
    return F.when((w.endswith("y") | w.endswith("Y")) & w.rlike(f"^.+{OTHER}.$"), F.concat(_less(w, 1), F.lit("i"))).otherwise(w)


def _suffixes(w: Column, at: Callable[[str], Column], rules: Sequence[tuple[str, str]], after: dict[str, str]) -> Column:
    """The longest suffix counts, whether or not it lies in its region."""
    def one(suffix: str, new: str) -> tuple[Column, Column]:
        ok = F.length(w) - len(suffix) >= at(suffix)
        if suffix in after:
            ok = ok & _less(w, len(suffix)).rlike(after[suffix])
        return w.endswith(suffix), F.when(ok, F.concat(_less(w, len(suffix)), F.lit(new))).otherwise(w)

    return _first([one(s, n) for s, n in sorted(rules, key=lambda r: -len(r[0]))], w)


def _step_2(w: Column, r1: Column, r2: Column) -> Column:
    return _suffixes(w, lambda s: r1, STEP_2, STEP_2_AFTER)


def _step_3(w: Column, r1: Column, r2: Column) -> Column:
    return _suffixes(w, lambda s: r2 if s == "ative" else r1, STEP_3, {})


def _step_4(w: Column, r1: Column, r2: Column) -> Column:
    return _suffixes(w, lambda s: r2, [(s, "") for s in STEP_4], STEP_4_AFTER)


def _step_5(w: Column, r1: Column, r2: Column) -> Column:
    n = F.length(w) - 1
    gone = (w.endswith("e") & ((n >= r2) | ((n >= r1) & ~_less(w, 1).rlike(SHORT)))) | (w.endswith("ll") & (n >= r2))
    return F.when(gone, _less(w, 1)).otherwise(w)


LATER: tuple[Step, ...] = (_step_1b, _step_1b_rest, _step_1c, _step_2, _step_3, _step_4, _step_5)


def _end(word: Column, after_1a: Column, stemmed: Column) -> Column:
    cases = [(word == k, F.lit(v)) for k, v in SPECIAL.items()]
    return _first([(F.length(word) <= 2, word), (~word.isin(list(SPECIAL)) & ~after_1a.isin(list(SPECIAL_1A)), F.translate(stemmed, "Y", "y")),
                   *cases], after_1a)


def porter2(word: Column) -> Column:
    """The stem of one word."""
    def steps(w: Column, r1: Column, r2: Column, rest: tuple[Step, ...], done: Callable[[Column], Column]) -> Column:
        return done(w) if not rest else let(rest[0](w, r1, r2), lambda x: steps(x, r1, r2, rest[1:], done))

    return let(word, lambda x: let(marked(x), lambda w: let(region(w, 0, R1_WORDS), lambda r1: let(region(w, r1), lambda r2: let(
        _step_1a(w, r1, r2), lambda a: steps(a, r1, r2, LATER, lambda s: _end(x, a, s)))))))


def _fixed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that later expressions refer to: the optimiser doesn't put its expression in the place of its name, as it does
    with projections (each step names the one before several times, so the expressions would multiply)."""
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def porter2_rows(df: DataFrame, column: str) -> DataFrame:
    """The table with the words of ``column`` stemmed, step by step."""
    own = ["_stem_w", "_stem_r1", "_stem_r2", "_stem_a"]
    w, r1, r2, a = (F.col(c) for c in own)
    out = _fixed(df, "_stem_w", marked(F.col(column)))
    out = _fixed(_fixed(out, "_stem_r1", region(w, 0, R1_WORDS)), "_stem_r2", region(w, r1))
    out = _fixed(out, "_stem_a", _step_1a(w, r1, r2)).withColumn("_stem_w", a)
    for step in LATER:
        out = _fixed(out, "_stem_w", step(w, r1, r2))
    return _fixed(out, column, _end(F.col(column), a, w)).select(*df.columns)
