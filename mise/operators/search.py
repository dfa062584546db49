"""Search operators over search documents.

Predicates are Spark columns evaluated row-locally (``exists`` over the nested ingredients
instead of exploding), scored queries go through :mod:`mise.operators.scoring`, and every
ranked result ends in ``orderBy(...).limit(k)``, which Spark plans as a top-k
(TakeOrderedAndProject), never a global sort collected to the driver.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.analysis import RUNS, Analyzer, english, ingredient_analyzer, stem_of
from ..functions.text import let
from ..session import cut_lineage
from . import fuzzy as FZ
from . import index as IX
from .relational import _order, page
from .scoring import bm25, query_terms, read_lengths, read_postings


# ----------------------------------------------------------------------------------- helpers
def _top(df: DataFrame, k: int, score: str = "score", key: str = "id") -> DataFrame:
    """Top ``k`` by score, then key.  Scores are compared at 6 decimals: sums of the same terms
    added in a different order differ in the last bits, and ties must fall to the key."""
    return df.orderBy(F.round(F.col(score), 6).desc_nulls_last(), F.col(key).asc()).limit(k)


def _attach(docs: DataFrame, scores: DataFrame, k: int, key: str = "id") -> DataFrame:
    """Top ``k`` scores joined back to their documents (a broadcast of at most ``k`` rows)."""
    best = _top(scores, k, key=key)
    return docs.join(F.broadcast(best), key).orderBy(F.round(F.col("score"), 6).desc(), F.col(key))


def lit_array(values: Sequence) -> Column:
    return F.array(*[F.lit(v) for v in values])


# -------------------------------------------------------------------------------------- S4
def match_all(df: DataFrame, from_: int = 0, size: int = 10, order: Sequence = ("id",)) -> DataFrame:
    return page(df, order, size, from_)


# ------------------------------------------------------------------------------ S5 - S7, S33
def _index_of(docs: DataFrame, fields: Mapping[str, float], analyzers: Mapping[str, Analyzer] | None,
              index: str | IX.Index | None) -> IX.Index | str:
    """What answers a query's questions: the index given, else the documents themselves, read once."""
    return IX.DocumentIndex(docs, IX.document_fields(fields, analyzers)) if index is None else index


def match(docs: DataFrame, field: str, text: str, analyzer: Analyzer = english, k: int = 10,
          index: str | IX.Index | None = None) -> DataFrame:
    """BM25 on one field, any term; top ``k`` documents with ``score``.  ``index`` is an index of
    :mod:`mise.operators.index`, or the path of one written by :func:`mise.operators.scoring.write_postings`."""
    scores = field_scores(docs, text, {field: 1.0}, {field: analyzer}, index)
    return _attach(docs, scores.select("id", "score"), k)


def field_scores(docs: DataFrame, text: str, fields: Mapping[str, float],
                 analyzers: Mapping[str, Analyzer] | None = None, index: str | IX.Index | None = None) -> DataFrame:
    """(id, field, score) for every field with a boost, in one job."""
    index = _index_of(docs, fields, analyzers, index)
    if not isinstance(index, str):
        return IX.field_scores(index, text, fields)
    out, spark = None, docs.sparkSession
    for f, boost in fields.items():
        terms = query_terms(spark, text, (analyzers or {}).get(f, english))
        s = bm25(read_postings(spark, index, terms, f), read_lengths(spark, index), terms, f, boost=boost).withColumn("field", F.lit(f))
        out = s if out is None else out.unionByName(s)
    return out


def combine_fields(scores: DataFrame, tie_breaker: float = 0.0) -> DataFrame:
    """Best field wins; others add ``tie_breaker`` times their score."""
    g = scores.groupBy("id").agg(F.max("score").alias("_best"), F.sum("score").alias("_sum"))
    return g.select("id", (F.col("_best") + F.lit(tie_breaker) * (F.col("_sum") - F.col("_best"))).alias("score"))


def multi_match(docs: DataFrame, text: str, fields: Mapping[str, float], tie_breaker: float = 0.0,
                analyzers: Mapping[str, Analyzer] | None = None, k: int = 10,
                index: str | IX.Index | None = None) -> DataFrame:
    """``{'title': 2, 'description': 1}`` boosts; best field plus tie breaker.  With an index the fields may be
    of any kind it has: ``{'title': 5, 'cuisine_type': 3, 'ingredients.name': 1}``."""
    return _attach(docs, combine_fields(field_scores(docs, text, fields, analyzers, index), tie_breaker), k)


def search(docs: DataFrame, text: str, filters: Mapping[str, object] | None = None, size: int = 20,
           fields: Mapping[str, float] | None = None, index: str | IX.Index | None = None) -> DataFrame:
    """Multi-match (title^2, description by default) with exact-value filters, e.g.
    ``{'cuisine_type': 'Italian', 'difficulty': 'easy'}``; filters do not score."""
    fields = fields or {"title": 2.0, "description": 1.0}
    cond = F.lit(True)
    for c, v in (filters or {}).items():
        if v is not None:
            cond = cond & term(c, v)
    base = docs.filter(cond)
    # Term statistics come from the whole collection; only the hits are filtered.
    scores = combine_fields(field_scores(docs, text, fields, index=index)).join(base.select("id"), "id", "left_semi")
    return _attach(base, scores, size)


# ---------------------------------------------------------------------------- S8 - S10, S25
def term(column: str, values, is_array: bool = False) -> Column:
    """Exact match on a keyword field (``terms`` when ``values`` is a list)."""
    vals = list(values) if isinstance(values, (list, tuple, set)) else [values]
    if is_array:
        return F.coalesce(F.arrays_overlap(F.col(column), lit_array(vals)), F.lit(False))
    return F.coalesce(F.col(column).isin(vals), F.lit(False))


def range_filter(column: str, gte=None, lte=None, gt=None, lt=None) -> Column:
    """Missing values never match."""
    c = F.col(column)
    cond = c.isNotNull()
    if gte is not None:
        cond = cond & (c >= gte)
    if lte is not None:
        cond = cond & (c <= lte)
    if gt is not None:
        cond = cond & (c > gt)
    if lt is not None:
        cond = cond & (c < lt)
    return F.coalesce(cond, F.lit(False))


@dataclass
class Clause:
    """A query clause: a predicate and the score it contributes when it matches."""
    pred: Column
    score: Column | None = None
    boost: float = 1.0

    def score_col(self) -> Column:
        s = self.score if self.score is not None else F.lit(1.0)
        return F.when(self.pred, s * F.lit(self.boost)).otherwise(F.lit(0.0))


def _clause(c) -> Clause:
    return c if isinstance(c, Clause) else Clause(c)


def bool_query(df: DataFrame, must: Sequence = (), should: Sequence = (), must_not: Sequence = (),
               filter: Sequence = (), minimum_should_match: int | None = None) -> DataFrame:
    """Must / should / must_not / filter with minimum_should_match; adds ``score``.

    Scores of ``must`` and matched ``should`` clauses add up; ``filter`` and ``must_not`` do
    not score.  Without must/filter clauses at least one should clause must match.
    """
    must = [_clause(c) for c in must]
    should = [_clause(c) for c in should]
    cond = F.lit(True)
    for c in must:
        cond = cond & F.coalesce(c.pred, F.lit(False))
    for p in filter:
        cond = cond & F.coalesce(_clause(p).pred, F.lit(False))
    for p in must_not:
        cond = cond & ~F.coalesce(_clause(p).pred, F.lit(False))
    msm = minimum_should_match
    if msm is None:
        msm = 1 if (should and not must and not filter) else 0
    if should and msm > 0:
        hits = sum((F.coalesce(c.pred, F.lit(False)).cast("int") for c in should), F.lit(0))
        cond = cond & (hits >= msm)
    score = sum((c.score_col() for c in must + should), F.lit(0.0))
    return df.filter(cond).withColumn("score", score)


def min_score(df: DataFrame, s: float, score: str = "score") -> DataFrame:
    """S25."""
    return df.filter(F.col(score) >= s)


# ------------------------------------------------------------------------------ S11, S22, S23
def nested_scores(docs: DataFrame, text: str, score_mode: str = "sum", analyzer: Analyzer = ingredient_analyzer,
                  path: str = "ingredients", field: str = "name", index: IX.Index | None = None) -> DataFrame:
    """(id, score): BM25 of ``text`` on each nested entry, combined per document (sum/max/avg)."""
    nested = IX.nested_field(path, field, analyzer)
    source = index if index is not None else IX.DocumentIndex(docs, [nested])
    return IX.field_scores(source, text, {nested.name: 1.0}, score_mode).select("id", "score")


def nested_scores_flat(mentions: DataFrame, text: str, score_mode: str = "sum",
                       analyzer: Analyzer = ingredient_analyzer, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(id, score) from flat (id, name) mentions, equal to :func:`nested_scores`.

    An entry's BM25 depends only on its name, so names are scored once: mentions are counted
    per distinct name (partially aggregated, so a name in a third of all dishes costs one row
    per task), document frequencies are sums of those counts, and the per-name scores are
    joined back to the mentions (AQE broadcasts the scored names when small and splits a hot
    name otherwise)."""
    terms = query_terms(mentions.sparkSession, text, analyzer)
    # Counted once, and read by four branches.
    names = cut_lineage(mentions.groupBy("name").agg(F.count(F.lit(1)).alias("cnt")))
    toks = names.select("name", "cnt", analyzer(F.col("name")).alias("tokens")).withColumn("dl", F.size("tokens"))
    st = toks.agg(F.sum(F.when(F.col("dl") > 0, F.col("cnt"))).cast("double").alias("n"),
                  (F.sum(F.col("cnt") * F.col("dl")) / F.sum(F.when(F.col("dl") > 0, F.col("cnt")))).alias("a"))
    n_docs, avgdl = st.select("n").scalar(), st.select("a").scalar()
    post = (toks.select("name", "cnt", "dl", F.explode("tokens").alias("term"))
                .join(F.broadcast(terms), "term")
                .groupBy("name", "cnt", "dl", "term", "qtf").agg(F.count(F.lit(1)).alias("tf")))
    dfs = post.groupBy("term").agg(F.sum("cnt").alias("df"))
    idf = F.log(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf").cast("double")
    norm = tf / (tf + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("dl") / avgdl))
    per_name = (post.join(F.broadcast(dfs), "term")   # one row per query term
                    .groupBy("name").agg(F.sum(F.col("qtf") * idf * norm).alias("_s")))
    agg = {"sum": F.sum, "max": F.max, "avg": F.avg}[score_mode]
    return mentions.join(per_name, "name").groupBy("id").agg(agg("_s").alias("score"))


def nested_match(docs: DataFrame, text: str, score_mode: str = "sum", k: int = 10,
                 analyzer: Analyzer = ingredient_analyzer, flat: DataFrame | None = None,
                 index: IX.Index | None = None) -> DataFrame:
    """Documents with an ingredient matching any analysed term, scored by nested BM25
    (from flat (id, name) mentions when ``flat`` is given, from an index when ``index`` is)."""
    scores = (nested_scores_flat(flat, text, score_mode, analyzer) if flat is not None
              else nested_scores(docs, text, score_mode, analyzer, index=index))
    return _attach(docs, scores, k)


def any_of_ingredients(docs: DataFrame, terms: Sequence[str], k: int = 10, flat: DataFrame | None = None,
                       index: IX.Index | None = None) -> DataFrame:
    """At least one of the terms, nested scores summed."""
    return nested_match(docs, " ".join(terms), "sum", k, flat=flat, index=index)


def nested_match_pred(text: str, analyzer: Analyzer = ingredient_analyzer, path: str = "ingredients") -> Column:
    """Unscored form: some ingredient shares an analysed token with ``text``."""
    q = analyzer(F.lit(text))
    return F.coalesce(F.exists(path, lambda e: F.arrays_overlap(analyzer(e["name"]), q)), F.lit(False))


def recommend(docs: DataFrame, have: Sequence[str], k: int = 10) -> DataFrame:
    """Exact ingredient names; ranked by how many of the document's ingredients are in ``have``."""
    h = lit_array(list(have))
    matched = F.size(F.filter("ingredients", lambda e: F.coalesce(F.array_contains(h, e["name"]), F.lit(False))))
    return _top(docs.withColumn("matched", matched).filter(F.col("matched") > 0), k, score="matched")


# ------------------------------------------------------------------------------ S12 - S16
def wildcard_regex(pattern: str) -> str:
    """``*`` any run, ``?`` one character, everything else literal; anchored."""
    out = []
    for ch in pattern:
        out.append(".*" if ch == "*" else "." if ch == "?" else re.escape(ch))
    return "^" + "".join(out) + "$"


def wildcard(column: str | Column, pattern: str, case_insensitive: bool = False) -> Column:
    """Wildcard on the raw field value (not on analysed tokens)."""
    c = F.col(column) if isinstance(column, str) else column
    rx = ("(?is)" if case_insensitive else "(?s)") + wildcard_regex(pattern)
    return F.coalesce(c.rlike(rx), F.lit(False))


def nested_wildcard(pattern: str, case_insensitive: bool = True, path: str = "ingredients",
                    field: str = "name") -> Column:
    """Some nested entry's ``field`` matches; NULL names never match."""
    return F.coalesce(F.exists(path, lambda e: wildcard(e[field], pattern, case_insensitive)), F.lit(False))


def count_matches(df: DataFrame, pred: Column | None = None) -> DataFrame:
    """S14."""
    return (df.filter(pred) if pred is not None else df).agg(F.count(F.lit(1)).alias("count"))


def has_all(names: Sequence[str]) -> Column:
    """Every listed ingredient occurs (as a case-insensitive substring of some name)."""
    cond = F.lit(True)
    for n in names:
        cond = cond & nested_wildcard(f"*{n}*")
    return cond


def ingredient_filter(spec) -> Column:
    """Boolean ingredient filter as a predicate.

    ``spec`` is a term (substring of an ingredient name, case-insensitive) or a tuple
    ``('and', a, b, ...)``, ``('or', a, b, ...)`` or ``('not', a)``.
    """
    if isinstance(spec, str):
        return nested_wildcard(f"*{spec}*")
    op, *args = spec
    if op == "not":
        return ~ingredient_filter(args[0])
    parts = [ingredient_filter(a) for a in args]
    out = parts[0]
    for p in parts[1:]:
        out = (out & p) if op == "and" else (out | p)
    return out


def ingredient_filter_sets(ids: DataFrame, mentions: DataFrame, spec) -> DataFrame:
    """S16 over a flat (id, name) mention table, by semi / anti joins: for junction tables too
    large to nest.  Returns the matching ``id`` values."""
    if isinstance(spec, str):
        hit = mentions.filter(wildcard("name", f"*{spec}*", True)).select("id")
        return ids.join(hit, "id", "left_semi")
    op, *args = spec
    if op == "not":
        return ids.join(ingredient_filter_sets(ids, mentions, args[0]), "id", "left_anti")
    sets = [ingredient_filter_sets(ids, mentions, a) for a in args]
    out = sets[0]
    for s in sets[1:]:
        out = out.join(s, "id", "left_semi") if op == "and" else out.unionByName(s).distinct()
    return out


# ---------------------------------------------------------------------------- S17 - S21
def page_with_total(df: DataFrame, page_no: int = 1, size: int = 10, order: Sequence = ("id",)) -> DataFrame:
    """Rows of page ``page_no`` plus ``total_hits`` and ``total_pages`` (scalar subquery)."""
    total = df.select(F.count(F.lit(1))).scalar()
    hits = page(df, order, size, (page_no - 1) * size)
    return hits.withColumn("total_hits", total).withColumn("total_pages", F.ceil(total / F.lit(size)).cast("bigint"))


def sort_by(df: DataFrame, keys: Sequence) -> DataFrame:
    """Several keys; missing values sort last in both directions."""
    return df.orderBy(*_order(keys))


def quick(docs: DataFrame, max_minutes: int = 30, by: str = "time", difficulty: str = "easy",
          size: int = 10, from_: int = 0) -> DataFrame:
    """Easy and quick; ``by='time'`` (ascending) or ``by='score'`` (score, then time)."""
    hits = docs.filter(term("difficulty", difficulty) & range_filter("total_time_minutes", lte=max_minutes))
    order = ([("total_time_minutes", "asc"), "id"] if by == "time"
             else [("post_score", "desc"), ("total_time_minutes", "asc"), "id"])
    return page(hits, order, size, from_)


def diet_search(docs: DataFrame, meal_type: str | None = None, cuisine: str | None = None,
                tags: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Meal, cuisine and tag filters, and no ingredient matching an excluded word."""
    cond = F.lit(True)
    if meal_type is not None:
        cond = cond & term("meal_type", meal_type)
    if cuisine is not None:
        cond = cond & term("cuisine_type", cuisine)
    if tags:
        cond = cond & term("dietary_tags", list(tags), is_array=True)
    if exclude:
        cond = cond & ~nested_match_pred(" ".join(exclude))
    return docs.filter(cond)


def project_dishes(docs: DataFrame, difficulties: Sequence[str] = ("medium", "hard"), min_comments: int = 50,
                    min_time: int = 120, comments: str = "post_comments") -> DataFrame:
    """Long, engaged dishes, best scored first."""
    hits = docs.filter(term("difficulty", list(difficulties)) & range_filter(comments, gte=min_comments)
                       & range_filter("total_time_minutes", gte=min_time))
    return sort_by(hits, [("post_score", "desc"), "id"])


# ---------------------------------------------------------------------------------- S24
def discover(docs: DataFrame, ingredients: Sequence[str], cuisines: Sequence[str] = (), min_time: int | None = None,
             max_time: int | None = None, cuisine_boost: float = 2.0, time_boost: float = 1.5,
             min_score_: float = 2.0) -> DataFrame:
    """Exact ingredient names (one point per matching entry), cuisine in list, time range;
    at least one clause, summed score, minimum score."""
    names = lit_array(list(ingredients))
    n_match = F.size(F.filter("ingredients", lambda e: F.coalesce(F.array_contains(names, e["name"]), F.lit(False))))
    should = [Clause(n_match > 0, n_match.cast("double"))]
    if cuisines:
        should.append(Clause(term("cuisine_type", list(cuisines)), boost=cuisine_boost))
    if min_time is not None or max_time is not None:
        should.append(Clause(range_filter("total_time_minutes", gte=min_time, lte=max_time), boost=time_boost))
    return min_score(bool_query(docs, should=should, minimum_should_match=1), min_score_)


# ---------------------------------------------------------------------------------- S26
def more_like(docs: DataFrame, seed_id, field: str | Sequence[str] = "title", max_terms: int = 12, min_term_freq: int = 1,
              min_doc_freq: int = 5, k: int = 10, analyzer: Analyzer = english, index: IX.Index | None = None) -> DataFrame:
    """The seed's ``max_terms`` best terms of one or several fields by tf-idf (classic idf of the term
    in its field), then BM25 summed over them, seed excluded.

    The seed document is analysed first; corpus postings are then read for the seed's terms
    only (filtered before the shuffle), so the cost does not grow with the vocabulary."""
    names = [field] if isinstance(field, str) else list(field)
    source = index if index is not None else IX.DocumentIndex(docs, [IX.text_field(f, analyzer) for f in names])
    # One document's vocabulary.
    own = source.document_terms(seed_id).where(F.col("field").isin(names))
    own = own.select("field", "term", "tf", F.lit(1.0).alias("boost"), F.lit(1).cast("bigint").alias("qtf"))
    found = source.lookup(own)
    best = (IX.figures_of(own, found).where((F.col("tf") >= min_term_freq) & (F.col("df") >= min_doc_freq))
              .withColumn("tfidf", F.col("tf") * (F.lit(1.0) + F.log(F.col("n") / (F.col("df") + 1))))
              .orderBy(F.desc("tfidf"), F.asc("term"), F.asc("field")).limit(max_terms).drop("tf", "tfidf"))
    scores = IX.scored(source, found.postings, best).groupBy("id").agg(F.sum("score").alias("score"))
    return _attach(docs, scores.where(F.col("id") != F.lit(seed_id)), k)


# ---------------------------------------------------------------------------------- S27
def fuzzy_expansions(docs: DataFrame, text: str, field: str, prefix_length: int = 2, analyzer: Analyzer = english,
                     transpositions: bool = True) -> DataFrame:
    """(qterm, term, distance): the field's terms within AUTO distance of a query's, sharing ``prefix_length`` characters."""
    source = IX.DocumentIndex(docs, [IX.text_field(field, analyzer)])
    query = IX.query_terms(source, text, {field: 1.0})
    vocab = source.lookup_fuzzy(query, prefix_length)[1].frequencies.select("field", "term")
    return FZ.fuzzy_expansions(vocab, query, prefix_length, transpositions).select("qterm", "term", "distance")


def fuzzy_match(docs: DataFrame, text: str, fields: Mapping[str, float], prefix_length: int = 2, k: int = 10,
                analyzer: Analyzer = english, index: IX.Index | None = None) -> DataFrame:
    """Each query term is replaced by its fuzzy expansions; a document's score for a query
    term is its best expansion's BM25; fields combine best-field-wins with boosts."""
    return _attach(docs, fuzzy_scores(docs, text, fields, prefix_length, analyzer, index), k)


def fuzzy_scores(docs: DataFrame, text: str, fields: Mapping[str, float], prefix_length: int = 2,
                 analyzer: Analyzer = english, index: IX.Index | None = None) -> DataFrame:
    """(id, score) of :func:`fuzzy_match` before the top-k, all fields in one job."""
    source = index if index is not None else IX.DocumentIndex(docs, [IX.text_field(f, analyzer) for f in fields])
    query = IX.query_terms(source, text, fields)
    expansions, found = source.lookup_fuzzy(query, prefix_length)
    # Expansions grow with the vocabulary: no broadcast is asked for.
    terms = expansions.select("field", "term", "boost").distinct().withColumn("qtf", F.lit(1).cast("bigint"))
    per_term = IX.scored(source, found.postings, IX.figures_of(terms, found), small=False)
    best = (per_term.join(expansions.select("field", "term", "qterm"), ["field", "term"])
                    .groupBy("id", "field", "qterm").agg(F.max("score").alias("score")))
    return best.groupBy("id", "field").agg(F.sum("score").alias("score")).groupBy("id").agg(F.max("score").alias("score"))


# ------------------------------------------------------------------------------ S28 - S32
def popularity(df: DataFrame, factors: Mapping[str, float], base: float = 1.0) -> DataFrame:
    """``base`` (match_all) plus the sum of log10(1 + factor * value); missing counts 0."""
    s = F.lit(base)
    for c, f in factors.items():
        s = s + F.log10(F.lit(1.0) + F.lit(f) * F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    return df.withColumn("score", s)


def random_rows(df: DataFrame, n: int = 1, seed: int = 0, key: str = "id") -> DataFrame:
    """A seeded pick that does not depend on partitioning (digest of seed and key)."""
    return df.withColumn("_r", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))).orderBy("_r", key).limit(n).drop("_r")


WORD_RUNS = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"


def highlight_col(c: Column, terms: Sequence[str], pre: str = "<em>", post: str = "</em>") -> Column:
    """Wrap whole-word, case-insensitive occurrences of ``terms``.  The text is cut into runs of
    word characters (Unicode letters, digits, underscore) and of other characters, so a word
    boundary means the same thing whatever the regex engine's ``\\b`` does."""
    t = [x.lower() for x in terms]
    runs = F.regexp_extract_all(c, F.lit(WORD_RUNS), 0)
    return F.array_join(F.transform(runs, lambda r: F.when(F.lower(r).isin(t), F.concat(F.lit(pre), r, F.lit(post)))
                                    .otherwise(r)), "")


def highlight(df: DataFrame, cols: Sequence[str], terms: Sequence[str], pre: str = "<em>", post: str = "</em>") -> DataFrame:
    """Adds ``<col>_highlight`` with matched terms wrapped in tags."""
    if not terms:
        return df
    for c in cols:
        df = df.withColumn(f"{c}_highlight", highlight_col(F.col(c), terms, pre, post))
    return df


def highlight_match_col(c: Column, terms: Sequence[str], analyzer: Analyzer = english, pre: str = "<em>", post: str = "</em>") -> Column:
    """The text with every word marked whose analysed term is one of ``terms``: "cookies" marks "Cookie".  The text is cut
    into runs of word characters and of others, which are put together again, so the work grows with the text."""
    stem, stop, wanted = stem_of(analyzer), list(analyzer.stopwords or ()), list(terms)

    def one(run: Column) -> Column:
        def hit(low: Column) -> Column:
            # Few words have a wanted term: the other tests are made for these alone.
            return (stem(low) if stem else low).isin(wanted) & ~low.isin(stop) & run.rlike(r"^[\p{L}\p{N}]")

        return F.when(let(F.lower(run), hit), F.concat(F.lit(pre), run, F.lit(post))).otherwise(run)

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(RUNS), 0), one), "")


def highlight_match(df: DataFrame, cols: Sequence[str], text: str, analyzer: Analyzer = english, pre: str = "<em>",
                    post: str = "</em>") -> DataFrame:
    """Adds ``<col>_highlight`` with the words that match the query ``text`` as the analyser sees them
    (a plural marks its singular, stop words are never marked)."""
    # The query's own terms.
    terms = [r["term"] for r in query_terms(df.sparkSession, text, analyzer).collect()]
    return df.withColumns({f"{c}_highlight": highlight_match_col(F.col(c), terms, analyzer, pre, post) for c in cols})


def with_post_filter(df: DataFrame, aggs: Callable[[DataFrame], DataFrame], pred: Column) -> tuple[DataFrame, DataFrame]:
    """Aggregations see every hit; the returned hits are filtered afterwards."""
    return df.filter(pred), aggs(df)


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Source filtering (column pruning reaches the scan)."""
    return df.select(*cols)


# ---------------------------------------------------------------------------- S34, S35
def suggest(df: DataFrame, prefix: str, n: int = 5, field: str = "title") -> DataFrame:
    """Titles starting with ``prefix`` (case-insensitive), alphabetical, top ``n``."""
    hits = df.filter(F.lower(F.col(field)).startswith(prefix.lower()))
    return hits.orderBy(F.col(field), F.col("id")).limit(n)


def any_field(docs: DataFrame, text: str, text_fields: Sequence[str] = ("title", "description"),
              keyword_fields: Sequence[str] = ("cuisine_type", "difficulty", "meal_type"), k: int = 10,
              index: IX.Index | None = None) -> DataFrame:
    """A word in any field: BM25 on text fields, exact equality (score 1) on keyword fields.  An index answers for
    both: its postings of the exact fields say which documents hold one of the words."""
    words = sorted({w for w in re.split(r"\s+", text.strip()) if w})
    allsc = field_scores(docs, text, {f: 1.0 for f in text_fields}, index=index).select("id", "score")
    if keyword_fields and words and index is None:
        hit = None
        for f in keyword_fields:
            hit = F.col(f).isin(words) if hit is None else hit | F.col(f).isin(words)
        allsc = allsc.unionByName(docs.where(hit).select("id", F.lit(1.0).alias("score")))
    elif keyword_fields and words:
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lit(w).alias("term")) for f in keyword_fields for w in words]))
        terms = index.spark.range(1).select(pairs.alias("p")).select("p.*")
        allsc = allsc.unionByName(index.lookup(terms).postings.select("id", F.lit(1.0).alias("score")))
    return _attach(docs, allsc.groupBy("id").agg(F.max("score").alias("score")), k)
