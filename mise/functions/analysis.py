"""Text analysis for search (S1): lower-case, split on non-alphanumerics, drop stop words, stem.

The same rules are written as DuckDB SQL in the query catalog, so analysed tokens can be checked
independently.  ``english`` stems by the minimal English S-stemmer (plural endings only), which is the
search engine's ``minimal_english`` stemmer; ``english_porter`` by the Porter2 rules of :mod:`.stemming`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicon as lx
from .stemming import porter2, porter2_rows
from .text import ColumnOrName, col, let, offsets

#: A text column to an array of terms.  Attributes say what it does to tokens: ``stopwords``, and ``stem``, a column
#: expression over one token that keeps its first character, or None; ``stem_rows`` may name a form of it for a
#: column of tokens (DataFrame and column name to DataFrame).
Analyzer = Callable[[Column], Column]

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def _ends(x: Column, *suffixes: str) -> Column:
    out = None
    for s in suffixes:
        c = x.endswith(s)
        out = c if out is None else (out | c)
    return out


def minimal_stem(x: Column) -> Column:
    """Plural stripping: 'cookies' -> 'cookie', 'berries' -> 'berry'; 'glass', 'bus' unchanged.
    Suffix tests only (no regex), so it stays cheap inside generated code."""
    n = F.length(x)
    return (F.when((n < 3) | ~x.endswith("s"), x)
            .when(_ends(x, "us", "ss"), x)
            .when((n > 3) & x.endswith("ies") & ~_ends(x, "aies", "eies"),
                  F.concat(F.substring(x, 1, n - 3), F.lit("y")))
            .when(_ends(x, "ies", "aes", "oes", "ees"), x)
            .otherwise(F.substring(x, 1, n - 1)))


def tokens_col(text: ColumnOrName, stopwords: Sequence[str] | None = lx.ENGLISH_STOPWORDS,
               stem: bool | Callable[[Column], Column] = False) -> Column:
    """array<string> of analysed tokens, in text order (duplicates kept: they are term frequency).
    ``stem`` is a stemmer, or True for :func:`minimal_stem`."""
    toks = F.filter(F.split(F.lower(col(text)), TOKEN_SPLIT), lambda t: t != "")
    if stopwords:
        stop = list(stopwords)   # ``isin`` on a literal list becomes a hash-set lookup
        toks = F.filter(toks, lambda t: ~t.isin(stop))
    if stem:
        toks = F.transform(toks, minimal_stem if stem is True else stem)
    return toks


def unstemmed(analyzer: Analyzer) -> Analyzer:
    """The analyser without its stemmer, for token streams that are stemmed row by row."""
    if stem_of(analyzer) is None:
        return analyzer
    return lambda c: tokens_col(c, analyzer.stopwords, stem=False)


def stem_of(analyzer: Analyzer) -> Callable[[Column], Column] | None:
    return getattr(analyzer, "stem", None)


#: Runs of token characters, and of the characters between them.
RUNS = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def token_spans(text: ColumnOrName, analyzer: Analyzer) -> Column:
    """Array of (term, start, end): the analysed terms and where their words stand in the text (code points,
    end exclusive), stop words left out.  For texts to be shown: it works row by row."""
    stem, stop = stem_of(analyzer), list(analyzer.stopwords or ())

    def placed(runs: Column) -> Column:
        return let(offsets(F.transform(runs, F.length)), lambda at: F.transform(runs, lambda r, i: F.struct(
            r.alias("run"), at[i].alias("start"))))

    found = let(F.regexp_extract_all(col(text), F.lit(RUNS), 0), placed)
    words = F.filter(found, lambda r: r["run"].rlike(r"^[\p{L}\p{N}]") & ~F.lower(r["run"]).isin(stop))
    return F.transform(words, lambda r: F.struct(
        (stem(F.lower(r["run"])) if stem else F.lower(r["run"])).alias("term"), r["start"].alias("start"),
        (r["start"] + F.length(r["run"])).alias("end")))


def analyze(df: DataFrame, column: str, out: str = "tokens", stem: bool = False,
            stopwords: Sequence[str] | None = lx.ENGLISH_STOPWORDS) -> DataFrame:
    return df.withColumn(out, tokens_col(column, stopwords, stem))


# Field analysers of the search document: english (stemmed) for prose, standard + stop words for
# ingredient names, keyword (exact) for facets.
def english(text: ColumnOrName) -> Column:
    return tokens_col(text, lx.ENGLISH_STOPWORDS, stem=True)


def english_porter(text: ColumnOrName) -> Column:
    return tokens_col(text, lx.ENGLISH_STOPWORDS, stem=porter2)


def ingredient_analyzer(text: ColumnOrName) -> Column:
    return tokens_col(text, lx.ENGLISH_STOPWORDS, stem=False)


# Token-level form of the two analysers, used when tokens are exploded into rows: the
# per-token work then runs as ordinary (code-generated) column expressions.
english.stem = minimal_stem
english.stopwords = lx.ENGLISH_STOPWORDS
english_porter.stem = porter2
english_porter.stem_rows = porter2_rows
english_porter.stopwords = lx.ENGLISH_STOPWORDS
ingredient_analyzer.stem = None
ingredient_analyzer.stopwords = lx.ENGLISH_STOPWORDS
