"""Fuzzy expansions of query terms (S27): AUTO edit distance, a common prefix, swaps as one edit.

Two ways give the candidate terms, and the same test decides on both.  From a vocabulary, terms are
joined on their prefix.  A stored index keeps the deletion neighbourhood of each term: the term with
up to MOST_EDITS characters behind the prefix left out.  Two terms within d edits share a text that
each reaches by at most d deletions, so the neighbourhoods of the query's terms, which are few, are
joined with the stored ones by equality and no vocabulary is listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let

#: The most that AUTO allows.
MOST_EDITS = 2


def auto_fuzziness(term_col: Column) -> Column:
    """AUTO edit distance: 0 for 1-2 characters, 1 for 3-5, 2 above."""
    n = F.length(term_col)
    return F.when(n <= 2, 0).when(n <= 5, 1).otherwise(2)


def _none() -> Column:
    return F.array().cast("array<string>")


def swapped(t: Column) -> Column:
    """All texts with one pair of neighbouring characters swapped."""
    return F.when(F.length(t) > 1, F.transform(F.sequence(F.lit(1), F.length(t) - 1), lambda i: F.concat(
        t.substr(F.lit(1), i - 1), t.substr(i + 1, F.lit(1)), t.substr(i, F.lit(1)), t.substr(i + 2, F.length(t))))
    ).otherwise(_none())


def deleted(t: Column) -> Column:
    """All texts with one character left out."""
    return F.when(F.length(t) > 0, F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(
        t.substr(F.lit(1), i - 1), t.substr(i + 1, F.length(t))))).otherwise(_none())


def neighbourhood(term: Column, prefix_length: int, edits: Column | int = MOST_EDITS) -> Column:
    """The term's prefix followed by what is left of the rest after up to ``edits`` deletions."""
    edits = F.lit(edits) if isinstance(edits, int) else edits
    prefix, rest = F.substring(term, 1, prefix_length), term.substr(F.lit(prefix_length + 1), F.length(term))
    all_of = let(deleted(rest), lambda one: F.concat(F.array(rest), F.when(edits >= 1, one).otherwise(_none()),
                                                     F.when(edits >= 2, F.flatten(F.transform(one, deleted))).otherwise(_none())))
    return F.array_distinct(F.transform(all_of, lambda r: F.concat(prefix, r)))


def distance(term: Column, qterm: Column, limit: Column, transpositions: bool = True) -> Column:
    """Edit distance if it is within ``limit``, else something above it.  With ``transpositions`` a swap of
    neighbours is one edit (as in the search engine; characters between the two may be edited as well, so "ca" is 2
    from "abc"): the term is within d if ``levenshtein`` puts it within d - 1 of the query term with one swap, or if it
    equals it after two swaps or a deletion and a swap."""
    far = F.lit(MOST_EDITS + 1)
    plain = F.levenshtein(term, qterm)
    if not transpositions:
        return plain
    one = F.coalesce(F.array_min(F.transform(swapped(qterm), lambda v: F.levenshtein(term, v))) + 1, far)
    twice = F.flatten(F.transform(F.concat(swapped(qterm), deleted(qterm)), swapped))
    two = F.when((limit >= 2) & F.array_contains(twice, term), F.lit(2)).otherwise(far)
    return F.least(plain, F.when(limit >= 1, one).otherwise(far), two)


def decided(candidates: DataFrame, transpositions: bool = True) -> DataFrame:
    """Of candidates (field, qterm, term, _limit, ...) those within their limit, with ``distance``."""
    near = candidates.where(F.abs(F.length("term") - F.length("qterm")) <= MOST_EDITS)
    return (near.withColumn("distance", distance(F.col("term"), F.col("qterm"), F.col("_limit"), transpositions))
                .where("distance <= _limit").drop("_limit"))


def fuzzy_expansions(vocab: DataFrame, query: DataFrame, prefix_length: int = 2, transpositions: bool = True) -> DataFrame:
    """(field, boost, qterm, term, distance) from a vocabulary (field, term) and a query's terms (field, term, boost): terms
    within AUTO distance sharing the first ``prefix_length`` characters.  The prefix is an equi-join key, so no
    term pairs outside a prefix group are ever compared."""
    q = query.select("field", "boost", F.col("term").alias("qterm"), F.substring("term", 1, prefix_length).alias("_p"),
                     auto_fuzziness(F.col("term")).alias("_limit"))
    pairs = vocab.withColumn("_p", F.substring("term", 1, prefix_length)).join(F.broadcast(q), ["field", "_p"])
    return decided(pairs.drop("_p"), transpositions)
