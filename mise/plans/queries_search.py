"""Registered search (S) queries: text search on ``documents``, predicates and nested scoring on
the star-table documents.  The SQL side spells out the analyser and BM25 in DuckDB."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import stemming as ST
from ..functions.analysis import english, tokens_col
from ..functions.stemming import porter2_rows
from ..operators import aggregates as G
from ..operators import index as IX
from ..operators import names as NM
from ..operators import scoring as SC
from ..operators import search as S
from ..operators.keys import tasks_for
from ..operators.relational import RANK_SCALE, text_search
from ..session import ensure_checkpoint_dir, remove_folder
from . import bindings as B
from .catalog import MENTIONS_CTE, DISHES_CTE, register, with_ctes

# ------------------------------------------------------------------------------ SQL helpers
_STOP = "[" + ", ".join(f"'{w}'" for w in lx.ENGLISH_STOPWORDS) + "]"
_STEM = ("CASE WHEN length(t) < 3 OR NOT suffix(t, 's') THEN t "
         "WHEN regexp_matches(t, '[us]s$') THEN t "
         "WHEN length(t) > 3 AND regexp_matches(t, '[^ae]ies$') THEN substr(t, 1, length(t) - 3) || 'y' "
         "WHEN regexp_matches(t, '[iaoe]es$') THEN t "
         "ELSE substr(t, 1, length(t) - 1) END")


def sql_tokens(x: str, stem: bool = True) -> str:
    toks = (f"list_filter(regexp_split_to_array(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), "
            f"lambda t: t <> '' AND NOT list_contains({_STOP}, t))")
    return f"list_transform({toks}, lambda t: {_STEM})" if stem else toks


def sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_bm25(p: str, rel: str, field: str, query: str | None, stem: bool = True, key: str = "id",
             boost: float = 1.0, terms_cte: str | None = None) -> list[str]:
    """CTEs ending in ``{p}_sc(id, score)``: BM25 of ``query`` on ``rel.field``."""
    q = terms_cte or f"{p}_q"
    ctes = [
        f"{p}_tok AS (SELECT {key} AS id, {sql_tokens(field, stem)} AS toks FROM {rel})",
        f"{p}_len AS (SELECT id, len(toks) AS dl FROM {p}_tok WHERE len(toks) > 0)",
        f"{p}_st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM {p}_len)",
    ]
    if terms_cte is None:
        ctes.append(f"{q} AS (SELECT t AS term, count(*) AS qtf FROM (SELECT unnest({sql_tokens(sql_lit(query), stem)}) "
                    f"AS t) GROUP BY t)")
    ctes += [
        f"{p}_post AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(toks) AS term FROM {p}_tok) "
        f"WHERE term IN (SELECT term FROM {q}) GROUP BY id, term)",
        f"{p}_df AS (SELECT term, count(*) AS df FROM {p}_post GROUP BY term)",
        f"{p}_sc AS (SELECT p.id, sum(q.qtf * ln(1 + (s.n - d.df + 0.5) / (d.df + 0.5)) * "
        f"(p.tf / (p.tf + 1.2 * (0.25 + 0.75 * l.dl / s.avgdl))) * {boost}) AS score "
        f"FROM {p}_post p JOIN {q} q ON p.term = q.term JOIN {p}_df d ON p.term = d.term "
        f"JOIN {p}_len l ON p.id = l.id CROSS JOIN {p}_st s GROUP BY p.id)",
    ]
    return ctes


TDOCS_CTE = """
tdocs AS (
  SELECT doc_id AS id, split_part(text, chr(10), 1) AS title,
         CASE WHEN position(chr(10) IN text) > 0 THEN substr(text, length(split_part(text, chr(10), 1)) + 2) END
           AS description,
         text, lang, source FROM documents)"""

_TOP10 = "SELECT id, round(score, 6) AS score FROM {sc} ORDER BY score DESC, id LIMIT {k}"


def _scores(df, k=10):
    return df.select("id", F.round("score", 6).alias("score"))


# ---------------------------------------------------------------------------------- S1 / S2
@register("analyze_documents", with_ctes(TDOCS_CTE) + f"""
SELECT id, CAST(len(toks) AS INTEGER) AS n_tokens, md5(array_to_string(toks, ' ')) AS tokens_md5
FROM (SELECT id, {sql_tokens('text')} AS toks FROM tdocs)""")
def analyze_documents(spark, d):
    t = B.text_documents(spark, d).select("id", english(F.col("text")).alias("toks"))
    return t.select("id", F.size("toks").alias("n_tokens"), F.md5(F.array_join("toks", " ")).alias("tokens_md5"))


@register("term_statistics", with_ctes(TDOCS_CTE) + f"""
SELECT 'description' AS field, term, count(*) AS df, sum(tf) AS cf FROM (
  SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({sql_tokens('description')}) AS term FROM tdocs)
  GROUP BY id, term) GROUP BY term""")
def term_statistics(spark, d):
    docs = B.text_documents(spark, d)
    post = SC.build_postings(docs, {"description": english})
    return SC.document_frequency(post).select("field", "term", "df", "cf")


# ---------------------------------------------------------------------------- S3 - S7, S33
@register("bm25_match", with_ctes(TDOCS_CTE, *sql_bm25("m", "tdocs", "description", "der und die")) + "\n"
          + _TOP10.format(sc="m_sc", k=10))
def bm25_match(spark, d):
    return _scores(S.match(B.text_documents(spark, d), "description", "der und die", k=10))


def _mm_sql(query: str, fields: dict, tb: float, k: int, where: str = "") -> str:
    ctes = [TDOCS_CTE]
    parts = []
    for i, (f, boost) in enumerate(fields.items()):
        ctes += sql_bm25(f"f{i}", "tdocs", f, query, boost=boost)
        parts.append(f"SELECT id, score FROM f{i}_sc")
    ctes.append("allsc AS (" + " UNION ALL ".join(parts) + ")")
    ctes.append(f"comb AS (SELECT id, max(score) + {tb} * (sum(score) - max(score)) AS score FROM allsc "
                f"GROUP BY id)")
    filt = f" WHERE id IN (SELECT id FROM tdocs WHERE {where})" if where else ""
    return with_ctes(*ctes) + f"\nSELECT id, round(score, 6) AS score FROM comb{filt} ORDER BY score DESC, id LIMIT {k}"


@register("multi_match_documents", _mm_sql("les des que", {"title": 2.0, "description": 1.0}, 0.3, 10))
def multi_match_documents(spark, d):
    return _scores(S.multi_match(B.text_documents(spark, d), "les des que", {"title": 2.0, "description": 1.0},
                                 tie_breaker=0.3, k=10))


@register("filtered_search", _mm_sql("les des que", {"title": 2.0, "description": 1.0}, 0.0, 20,
                                     "lang = 'fr' AND source = 'src3'"))
def filtered_search(spark, d):
    return _scores(S.search(B.text_documents(spark, d), "les des que", {"lang": "fr", "source": "src3"}, size=20))


@register("match_all_page", """
SELECT doc_id AS id, lang FROM documents ORDER BY doc_id LIMIT 10 OFFSET 10""")
def match_all_page(spark, d):
    return S.match_all(B.text_documents(spark, d), from_=10, size=10).select("id", "lang")


# ---------------------------------------------------------------------------- S8 - S10, S25
@register("bool_dishes", with_ctes(DISHES_CTE) + """
SELECT id, (1.0 + CASE WHEN cuisine_type IN ('1-URGENT', '2-HIGH') THEN 2.0 ELSE 0.0 END
           + CASE WHEN post_score >= 50 THEN 1.0 ELSE 0.0 END) AS score
FROM dishes
WHERE difficulty = 'F' AND total_time_minutes IS NOT NULL AND total_time_minutes <= 60
  AND NOT (meal_type = 'low') AND (cuisine_type IN ('1-URGENT', '2-HIGH') OR post_score >= 50)""")
def bool_dishes(spark, d):
    docs = B.documents(spark, d)
    out = S.bool_query(docs, must=[S.term("difficulty", "F")],
                       should=[S.Clause(S.term("cuisine_type", ["1-URGENT", "2-HIGH"]), boost=2.0),
                               S.range_filter("post_score", gte=50)],
                       must_not=[S.term("meal_type", "low")], filter=[S.range_filter("total_time_minutes", lte=60)],
                       minimum_should_match=1)
    return out.select("id", "score")


@register("discover_dishes", with_ctes(DISHES_CTE, MENTIONS_CTE, """
n AS (SELECT id, count(*) AS n FROM mentions WHERE name IN ('red widget', 'hot plate') GROUP BY id),
sc AS (SELECT r.id, coalesce(n.n, 0) * 1.0
               + CASE WHEN r.cuisine_type IN ('1-URGENT', '2-HIGH') THEN 2.0 ELSE 0.0 END
               + CASE WHEN r.total_time_minutes BETWEEN 15 AND 45 THEN 1.5 ELSE 0.0 END AS score,
              coalesce(n.n, 0) > 0 OR r.cuisine_type IN ('1-URGENT', '2-HIGH')
               OR coalesce(r.total_time_minutes BETWEEN 15 AND 45, false) AS any_hit
       FROM dishes r LEFT JOIN n ON r.id = n.id)""") + """
SELECT id, score FROM sc WHERE any_hit AND score >= 2""")
def discover_dishes(spark, d):
    out = S.discover(B.documents(spark, d), ["red widget", "hot plate"], ["1-URGENT", "2-HIGH"], 15, 45)
    return out.select("id", "score")


# ------------------------------------------------------------------------------ S11, S22, S23
def _nested_sql(query: str, k: int) -> str:
    ents = "ents AS (SELECT row_number() OVER () AS eid, id, name FROM mentions)"
    ctes = [MENTIONS_CTE, ents] + sql_bm25("n", "ents", "name", query, stem=False, key="eid")
    ctes.append("per_doc AS (SELECT e.id, sum(s.score) AS score FROM n_sc s JOIN ents e ON s.id = e.eid GROUP BY e.id)")
    return with_ctes(*ctes) + f"\nSELECT id, round(score, 6) AS score FROM per_doc ORDER BY score DESC, id LIMIT {k}"


@register("nested_ingredient_match", _nested_sql("widget hot", 10))
def nested_ingredient_match(spark, d):
    return _scores(S.nested_match(B.dishes(spark, d), "widget hot", "sum", k=10, flat=B.mentions(spark, d, ())))


@register("seasonal_ingredients", _nested_sql("anvil gizmo", 10))
def seasonal_ingredients(spark, d):
    return _scores(S.any_of_ingredients(B.documents(spark, d), ["anvil", "gizmo"], k=10))


@register("nested_match_documents", _nested_sql("widget hot", 10))
def nested_match_documents(spark, d):
    """The nested-document form of S11 (posexplode of the ingredient arrays)."""
    return _scores(S.nested_match(B.documents(spark, d), "widget hot", "sum", k=10))


@register("recommend_dishes", with_ctes(MENTIONS_CTE) + """
SELECT id, count(*) AS matched FROM mentions WHERE name IN ('red widget', 'hot plate', 'small gear')
GROUP BY id ORDER BY matched DESC, id LIMIT 10""")
def recommend_dishes(spark, d):
    out = S.recommend(B.documents(spark, d), ["red widget", "hot plate", "small gear"], k=10)
    return out.select("id", F.col("matched").cast("bigint").alias("matched"))


# ------------------------------------------------------------------------------ S12 - S16
@register("title_wildcard", with_ctes(TDOCS_CTE) + """
SELECT id FROM tdocs WHERE regexp_full_match(title, '.*ou.*n.*', 's')""")
def title_wildcard(spark, d):
    return B.text_documents(spark, d).filter(S.wildcard("title", "*ou*n*")).select("id")


_HAS = "EXISTS (SELECT 1 FROM mentions m WHERE m.id = r.id AND m.name ILIKE '%{t}%')"


@register("nested_wildcard_dishes", with_ctes(DISHES_CTE, MENTIONS_CTE) + f"""
SELECT id FROM dishes r WHERE {_HAS.format(t='red w')}""")
def nested_wildcard_dishes(spark, d):
    return B.documents(spark, d).filter(S.nested_wildcard("*RED W*")).select("id")


@register("count_widget_dishes", with_ctes(DISHES_CTE, MENTIONS_CTE) + f"""
SELECT count(*) AS count FROM dishes r WHERE {_HAS.format(t='widget')}""")
def count_widget_dishes(spark, d):
    return S.count_matches(B.documents(spark, d), S.nested_wildcard("*widget*"))


@register("has_all_ingredients", with_ctes(DISHES_CTE, MENTIONS_CTE) + f"""
SELECT id FROM dishes r WHERE {_HAS.format(t='widget')} AND {_HAS.format(t='gear')}""")
def has_all_ingredients(spark, d):
    return B.documents(spark, d).filter(S.has_all(["widget", "gear"])).select("id")


_SPEC = ("and", "widget", ("or", "hot", "cold"), ("not", "anvil"))
_SPEC_SQL = (f"{_HAS.format(t='widget')} AND ({_HAS.format(t='hot')} OR {_HAS.format(t='cold')}) "
             f"AND NOT {_HAS.format(t='anvil')}")


@register("boolean_ingredients", with_ctes(DISHES_CTE, MENTIONS_CTE) + f"""
SELECT id FROM dishes r WHERE {_SPEC_SQL}""")
def boolean_ingredients(spark, d):
    return B.documents(spark, d).filter(S.ingredient_filter(_SPEC)).select("id")


@register("boolean_ingredients_sets", with_ctes(DISHES_CTE, MENTIONS_CTE) + f"""
SELECT id FROM dishes r WHERE {_SPEC_SQL}""")
def boolean_ingredients_sets(spark, d):
    m = B.junction(spark, d).join(B.ingredients(spark, d).select(F.col("id").alias("ingredient_id"), "name"),
                                  "ingredient_id").select(F.col("dish_id").alias("id"), "name")
    return S.ingredient_filter_sets(B.dishes(spark, d).select("id"), m, _SPEC)


@register("boolean_ingredients_names", with_ctes(DISHES_CTE, MENTIONS_CTE) + f"""
SELECT id FROM dishes r WHERE {_SPEC_SQL}""")
def boolean_ingredients_names(spark, d):
    """The same by distinct names and their pieces: mentions are met by equality only."""
    m = B.mentions(spark, d, ())
    names = NM.name_table(B.ingredients(spark, d))
    return NM.ingredient_filter_names(B.dishes(spark, d).select("id"), m, names, NM.gram_table(names), _SPEC)


@register("ilike_ingredients_names", """
SELECT p_partkey AS id, p_name AS name FROM part WHERE p_name ILIKE '%D W%' OR p_type ILIKE '%D W%'""")
def ilike_ingredients_names(spark, d):
    """R10 by pieces of the distinct names and categories."""
    parts = B.ingredients(spark, d)
    tables = {c: (n := NM.name_table(parts, c), NM.gram_table(n)) for c in ("name", "category")}
    return NM.ilike_names(parts, "D W", ["name", "category"], tables).select("id", "name")


# ---------------------------------------------------------------------------- S17 - S21
@register("page_with_total", """
SELECT doc_id AS id, (SELECT count(*) FROM documents WHERE lang = 'en') AS total_hits,
       CAST(ceil((SELECT count(*) FROM documents WHERE lang = 'en') / 10.0) AS BIGINT) AS total_pages
FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 10 OFFSET 20""")
def page_with_total(spark, d):
    docs = B.text_documents(spark, d).filter(F.col("lang") == "en")
    return S.page_with_total(docs, 3, 10).select("id", "total_hits", "total_pages")


@register("quick_dishes", with_ctes(DISHES_CTE) + """
SELECT id, total_time_minutes FROM dishes WHERE difficulty = 'F' AND total_time_minutes <= 30
ORDER BY total_time_minutes, id LIMIT 10""")
def quick_dishes(spark, d):
    return S.quick(B.documents(spark, d), 30, by="time", difficulty="F").select("id", "total_time_minutes")


@register("quick_dishes_by_score", with_ctes(DISHES_CTE) + """
SELECT id, post_score, total_time_minutes FROM dishes WHERE difficulty = 'F' AND total_time_minutes <= 30
ORDER BY post_score DESC NULLS LAST, total_time_minutes, id LIMIT 10""")
def quick_dishes_by_score(spark, d):
    return S.quick(B.documents(spark, d), 30, by="score", difficulty="F").select(
        "id", "post_score", "total_time_minutes")


@register("sorted_dishes", with_ctes(DISHES_CTE) + """
SELECT id, post_score, total_time_minutes FROM dishes""")
def sorted_dishes(spark, d):
    return S.sort_by(B.documents(spark, d), [("post_score", "desc"), ("total_time_minutes", "asc"), "id"]).select(
        "id", "post_score", "total_time_minutes")


@register("diet_search", with_ctes(DISHES_CTE, MENTIONS_CTE) + """
SELECT r.id FROM dishes r
WHERE r.meal_type = 'urgent' AND r.cuisine_type = '1-URGENT'
  AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = r.id AND l.l_returnflag IN ('R'))
  AND NOT EXISTS (SELECT 1 FROM mentions m WHERE m.id = r.id
                  AND (m.name LIKE '%anvil%' OR m.name LIKE '%gizmo%'))""")
def diet_search(spark, d):
    docs = B.documents(spark, d, tags=True)
    return S.diet_search(docs, "urgent", "1-URGENT", ["R"], ["anvil", "gizmo"]).select("id")


@register("project_dishes", with_ctes(DISHES_CTE) + """
SELECT id, post_score FROM dishes
WHERE difficulty IN ('O', 'P') AND post_comments >= 50 AND total_time_minutes >= 120""")
def project_dishes(spark, d):
    return S.project_dishes(B.documents(spark, d), ["O", "P"], 50, 120).select("id", "post_score")


# ---------------------------------------------------------------------------- S26 - S35
def _like_sql(fields: list[str], k: int = 10) -> str:
    """More like document 0: the best 12 (field, term) pairs, then BM25 of each summed."""
    ctes = [TDOCS_CTE]
    for i, f in enumerate(fields):
        ctes += [f"tok{i} AS (SELECT id, {sql_tokens(f)} AS toks FROM tdocs)",
                 f"post{i} AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(toks) AS term FROM tok{i}) GROUP BY id, term)",
                 f"st{i} AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM tok{i} WHERE len(toks) > 0)",
                 f"dfs{i} AS (SELECT term, count(*) AS df FROM post{i} GROUP BY term)"]
    ctes.append("seed AS (SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT {i} AS field, p.term, d.df, s.n, s.avgdl, p.tf * (1 + ln(s.n / (d.df + 1))) AS w FROM post{i} p JOIN dfs{i} d ON p.term = d.term "
        f"CROSS JOIN st{i} s WHERE p.id = 0 AND p.tf >= 1 AND d.df >= 5" for i in range(len(fields)))
        + f") ORDER BY w DESC, term, CASE field {' '.join(f'WHEN {i} THEN {chr(39)}{f}{chr(39)}' for i, f in enumerate(fields))} END LIMIT 12)")
    ctes.append("sc AS (SELECT id, sum(score) AS score FROM (" + " UNION ALL ".join(
        f"SELECT p.id, ln(1 + (q.n - q.df + 0.5) / (q.df + 0.5)) * (p.tf / (p.tf + 1.2 * (0.25 + 0.75 * len(t.toks) / q.avgdl))) AS score "
        f"FROM post{i} p JOIN seed q ON q.field = {i} AND p.term = q.term JOIN tok{i} t ON p.id = t.id" for i in range(len(fields)))
        + ") WHERE id <> 0 GROUP BY id)")
    return with_ctes(*ctes) + "\n" + _TOP10.format(sc="sc", k=k)


@register("more_like_document", _like_sql(["title", "description"]))
def more_like_document(spark, d):
    return _scores(S.more_like(B.text_documents(spark, d), 0, ["title", "description"], 12, 1, 5, k=10))


@register("more_like_description", _like_sql(["description"]))
def more_like_description(spark, d):
    return _scores(S.more_like(B.text_documents(spark, d), 0, "description", 12, 1, 5, k=10))


def _fuzzy_sql(text: str, fields: dict[str, float], k: int = 10) -> str:
    ctes = [TDOCS_CTE, f"q AS (SELECT DISTINCT unnest({sql_tokens(sql_lit(text))}) AS qterm)"]
    for i, (f, boost) in enumerate(fields.items()):
        ctes += [f"vocab{i} AS (SELECT DISTINCT unnest({sql_tokens(f)}) AS term FROM tdocs)", f"""
exp{i} AS (SELECT q.qterm, v.term FROM vocab{i} v JOIN q ON substr(v.term, 1, 2) = substr(q.qterm, 1, 2)
        WHERE damerau_levenshtein(v.term, q.qterm) <= CASE WHEN length(q.qterm) <= 2 THEN 0
                                                   WHEN length(q.qterm) <= 5 THEN 1 ELSE 2 END
          AND abs(length(v.term) - length(q.qterm)) <= 2),
eterms{i} AS (SELECT DISTINCT term, 1 AS qtf FROM exp{i})""", *sql_bm25(f"fz{i}", "tdocs", f, None, terms_cte=f"eterms{i}"), f"""
fz{i}_pt AS (SELECT p.id, p.term, sum(q.qtf * ln(1 + (s.n - d.df + 0.5) / (d.df + 0.5)) *
                 (p.tf / (p.tf + 1.2 * (0.25 + 0.75 * l.dl / s.avgdl))) * {boost}) AS score
          FROM fz{i}_post p JOIN eterms{i} q ON p.term = q.term JOIN fz{i}_df d ON p.term = d.term
          JOIN fz{i}_len l ON p.id = l.id CROSS JOIN fz{i}_st s GROUP BY p.id, p.term),
per_q{i} AS (SELECT t.id, e.qterm, max(t.score) AS score FROM fz{i}_pt t JOIN exp{i} e ON t.term = e.term GROUP BY t.id, e.qterm),
tot{i} AS (SELECT id, sum(score) AS score FROM per_q{i} GROUP BY id)"""]
    ctes.append("tot AS (SELECT id, max(score) AS score FROM (" + " UNION ALL ".join(
        f"SELECT * FROM tot{i}" for i in range(len(fields))) + ") GROUP BY id)")
    return with_ctes(*ctes) + "\n" + _TOP10.format(sc="tot", k=k)


_FUZZY = {"title": 3.0, "description": 1.0}


@register("fuzzy_documents", _fuzzy_sql("dier unnd lees", _FUZZY))
def fuzzy_documents(spark, d):
    return _scores(S.fuzzy_match(B.text_documents(spark, d), "dier unnd lees", _FUZZY, 2, k=10))


# -------------------------------------------------------- S2, S6, S26, S27, S30, S35 over several fields
DISH_FIELDS = (IX.text_field("title"), IX.text_field("description"), IX.keyword_field("cuisine_type"), IX.nested_field("ingredients", "name"),
               IX.nested_field("ingredients", "name", None, "ingredients.name.keyword"))
TEXT_FIELDS = (IX.text_field("title"), IX.text_field("description"), IX.keyword_field("lang"), IX.keyword_field("source"))


#: The stored indexes of this session by application and input: several queries read one.
_STORED: dict[tuple, str] = {}


def _stored(spark, d, name: str, docs, fields, column: str, first) -> IX.StoredIndex:
    """An index of all documents in two batches, as they would come: those with one value of a column, and the others."""
    key = (spark.sparkContext.applicationId, d, name)
    if key in _STORED:
        return IX.StoredIndex(spark, _STORED[key], fields)
    path = f"{ensure_checkpoint_dir(spark)}/index-{uuid.uuid4().hex}"
    index = IX.create_index(spark, path, fields, buckets=8)
    with docs() as found:
        index.add(found.where(F.col(column).eqNullSafe(first)), "first")
        index.add(found.where(~F.col(column).eqNullSafe(first)), "others")
    _STORED[key] = path
    return index


#: Documents that one task cuts into index rows, on average: it holds those rows to count them.
DOCUMENTS_PER_TASK = 100_000


@contextlib.contextmanager
def _built_dishes(spark, d):
    """What the index reads of the documents: joined and nested once for both batches and written, then dealt by id in parts
    of bounded size.  Removed when the batches are in."""
    folder = f"{ensure_checkpoint_dir(spark)}/built-{uuid.uuid4().hex}"
    docs = B.documents(spark, d, parts=["name"]).select("id", "difficulty", *sorted({f.column for f in DISH_FIELDS}))
    # Names alone: structs around them would be most of what is shuffled.
    flat = docs.withColumn("ingredients", F.col("ingredients")["name"])
    try:
        flat.write.option("compression", "zstd").parquet(folder)
        built = spark.read.schema(flat.schema).parquet(folder)
        built = built.repartition(tasks_for(built, DOCUMENTS_PER_TASK), "id")
        yield built.withColumn("ingredients", F.transform("ingredients", lambda n: F.struct(n.alias("name"))))
    finally:
        remove_folder(spark, folder)


def stored_dishes(spark, d) -> IX.StoredIndex:
    return _stored(spark, d, "dishes", lambda: _built_dishes(spark, d), DISH_FIELDS, "difficulty", "F")


def stored_documents(spark, d) -> IX.StoredIndex:
    # Dealt by id, so that a document's terms are counted where it is: its text is shuffled once, its postings are not.
    return _stored(spark, d, "documents", lambda: contextlib.nullcontext(B.text_documents(spark, d).repartition("id")), TEXT_FIELDS, "lang", "en")


def sql_exact(p: str, rel: str, column: str, value: str, boost: float) -> list[str]:
    """CTEs ending in ``{p}_sc(id, score)``: an exact value, without length norm; a document's entries add up."""
    return [f"{p}_st AS (SELECT count({column}) AS n, count(*) FILTER ({column} = {sql_lit(value)}) AS df FROM {rel})",
            f"{p}_sc AS (SELECT r.id, sum(ln(1 + (s.n - s.df + 0.5) / (s.df + 0.5)) * (1 / (1 + 1.2)) * {boost}) AS score "
            f"FROM {rel} r CROSS JOIN {p}_st s WHERE r.{column} = {sql_lit(value)} GROUP BY r.id)"]


DISH_BOOSTS = {"title": 5.0, "description": 2.0, "cuisine_type": 3.0, "ingredients.name": 1.0, "ingredients.name.keyword": 2.0}


def _dish_fields_sql(text: str, k: int = 10) -> str:
    """Title, cuisine and ingredient names, analysed and exact; best field and 0.3 of the others (dishes have no description)."""
    b = DISH_BOOSTS
    ctes = [DISHES_CTE, MENTIONS_CTE, "ents AS (SELECT row_number() OVER () AS eid, id, name FROM mentions)",
            *sql_bm25("t", "dishes", "title", text, boost=b["title"]), *sql_exact("c", "dishes", "cuisine_type", text, b["cuisine_type"]),
            *sql_bm25("n", "ents", "name", text, stem=False, key="eid", boost=b["ingredients.name"]),
            "nd_sc AS (SELECT e.id, sum(s.score) AS score FROM n_sc s JOIN ents e ON s.id = e.eid GROUP BY e.id)",
            *sql_exact("x", "mentions", "name", text, b["ingredients.name.keyword"]),
            "allsc AS (" + " UNION ALL ".join(f"SELECT id, score FROM {n}" for n in ("t_sc", "c_sc", "nd_sc", "x_sc")) + ")",
            "comb AS (SELECT id, max(score) + 0.3 * (sum(score) - max(score)) AS score FROM allsc GROUP BY id)"]
    return with_ctes(*ctes) + "\n" + _TOP10.format(sc="comb", k=k)


@register("multi_match_all_fields", _dish_fields_sql("2-HIGH"))
def multi_match_all_fields(spark, d):
    """Text, exact and nested fields of the documents, in one job."""
    docs = B.documents(spark, d)
    return _scores(S.multi_match(docs, "2-HIGH", DISH_BOOSTS, 0.3, index=IX.DocumentIndex(docs, DISH_FIELDS)))


@register("stored_multi_match_all_fields", _dish_fields_sql("small gear"))
def stored_multi_match_all_fields(spark, d):
    """The same from stored postings and statistics."""
    return _scores(S.multi_match(B.documents(spark, d), "small gear", DISH_BOOSTS, 0.3, index=stored_dishes(spark, d)))


@register("stored_nested_match", _nested_sql("widget hot", 10))
def stored_nested_match(spark, d):
    return _scores(S.nested_match(B.dishes(spark, d), "widget hot", "sum", k=10, index=stored_dishes(spark, d)))


@register("stored_filtered_search", _mm_sql("les des que", {"title": 2.0, "description": 1.0}, 0.0, 20, "lang = 'fr' AND source = 'src3'"))
def stored_filtered_search(spark, d):
    return _scores(S.search(B.text_documents(spark, d), "les des que", {"lang": "fr", "source": "src3"}, size=20,
                            index=stored_documents(spark, d)))


@register("stored_more_like", _like_sql(["title", "description"]))
def stored_more_like(spark, d):
    return _scores(S.more_like(B.text_documents(spark, d), 0, ["title", "description"], 12, 1, 5, k=10, index=stored_documents(spark, d)))


@register("stored_fuzzy", _fuzzy_sql("dier unnd lees", _FUZZY))
def stored_fuzzy(spark, d):
    """Expansions by stored deletion neighbourhoods: no vocabulary is listed."""
    return _scores(S.fuzzy_match(B.text_documents(spark, d), "dier unnd lees", _FUZZY, 2, k=10, index=stored_documents(spark, d)))


@register("stored_term_statistics", with_ctes(TDOCS_CTE) + "\n" + " UNION ALL ".join(f"""
SELECT '{f}' AS field, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM (
  SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({sql_tokens(f)}) AS term FROM tdocs) GROUP BY id, term) GROUP BY term"""
                                                                       for f in ("title", "description")))
def stored_term_statistics(spark, d):
    """Document frequencies kept batch by batch and added up."""
    return stored_documents(spark, d).frequencies().where("field IN ('title', 'description')")


_MARKED = "ders les Thes of"


@register("highlight_matches", with_ctes(TDOCS_CTE, f"""
runs AS (SELECT id, {sql_tokens(sql_lit(_MARKED))} AS q, title, description, regexp_extract_all(title, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+') AS title_runs,
                regexp_extract_all(description, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+') AS description_runs FROM tdocs),
stems AS (SELECT *, list_transform(list_transform(title_runs, lambda r: lower(r)), lambda t: {_STEM}) AS title_stems,
                 list_transform(list_transform(description_runs, lambda r: lower(r)), lambda t: {_STEM}) AS description_stems FROM runs)""") + """
SELECT id, """ + ", ".join(f"""md5(CASE WHEN {c} IS NOT NULL THEN array_to_string(list_transform(range(1, len({c}_runs) + 1), lambda i:
  CASE WHEN list_contains(q, {c}_stems[i]) AND NOT list_contains({_STOP}, lower({c}_runs[i])) THEN '<em>' || {c}_runs[i] || '</em>'
       ELSE {c}_runs[i] END), '') END) AS {c}_md5, CAST(len(list_filter(range(1, len({c}_runs) + 1), lambda i: list_contains(q, {c}_stems[i]) AND NOT
       list_contains({_STOP}, lower({c}_runs[i])))) AS INT) AS {c}_marks""" for c in ("title", "description")) + "\nFROM stems")
def highlight_matches(spark, d):
    """Words that match a query as analysed, marked in title and description: "ders" marks "Der"."""
    out = S.highlight_match(B.text_documents(spark, d), ["title", "description"], _MARKED)
    marks = [F.md5(F.col(f"{c}_highlight")).alias(f"{c}_md5") for c in ("title", "description")]
    counts = [(F.size(F.split(f"{c}_highlight", "<em>", -1)) - 1).alias(f"{c}_marks") for c in ("title", "description")]
    return out.select("id", *marks, *[F.when(F.col(f"{c}_highlight").isNotNull(), n).alias(f"{c}_marks") for c, n in zip(("title", "description"), counts)])


@register("popular_dishes", with_ctes(DISHES_CTE) + """
SELECT id, round(1.0 + log10(1 + 0.5 * coalesce(post_score, 0)) + log10(1 + 0.3 * coalesce(post_comments, 0)),
                 6) AS score
FROM dishes ORDER BY score DESC, id LIMIT 10""")
def popular_dishes(spark, d):
    out = S.popularity(B.documents(spark, d), {"post_score": 0.5, "post_comments": 0.3})
    return out.select("id", F.round("score", 6).alias("score")).orderBy(F.desc("score"), "id").limit(10)


@register("random_dish", with_ctes(DISHES_CTE) + """
SELECT id, title FROM dishes ORDER BY md5('7:' || CAST(id AS VARCHAR)), id LIMIT 1""")
def random_dish(spark, d):
    return S.random_rows(B.documents(spark, d), 1, seed=7).select("id", "title")


@register("highlight_titles", with_ctes(TDOCS_CTE) + """
SELECT id, array_to_string(list_transform(regexp_extract_all(title, '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_]+', 0),
                                          lambda r: CASE WHEN lower(r) IN ('der', 'les') THEN '<em>' || r || '</em>'
                                                         ELSE r END), '') AS title_highlight
FROM tdocs""")
def highlight_titles(spark, d):
    return S.highlight(B.text_documents(spark, d), ["title"], ["der", "les"]).select("id", "title_highlight")


@register("post_filter_hits", with_ctes(DISHES_CTE, MENTIONS_CTE) + """
SELECT r.id FROM dishes r WHERE r.difficulty = 'F'
  AND EXISTS (SELECT 1 FROM mentions m WHERE m.id = r.id AND m.name >= 'b' AND m.name <= 'gz')""")
def post_filter_hits(spark, d):
    docs = B.documents(spark, d).filter(S.term("difficulty", "F"))
    in_range = F.exists("ingredients", lambda e: (e["name"] >= "b") & (e["name"] <= "gz"))
    hits, _ = S.with_post_filter(docs, lambda x: G.filtered_mentions(x), F.coalesce(in_range, F.lit(False)))
    return hits.select("id")


@register("post_filter_aggs", with_ctes(DISHES_CTE, MENTIONS_CTE) + """
SELECT count(m.name) AS ingredient_mentions, count(DISTINCT r.id) AS hits
FROM dishes r LEFT JOIN mentions m ON m.id = r.id WHERE r.difficulty = 'F'""")
def post_filter_aggs(spark, d):
    docs = B.documents(spark, d).filter(S.term("difficulty", "F"))
    _, aggs = S.with_post_filter(docs, lambda x: G.filtered_mentions(x), F.lit(True))
    return aggs


@register("project_fields", with_ctes(DISHES_CTE) + """
SELECT id, title, difficulty FROM dishes""")
def project_fields(spark, d):
    return S.project(B.documents(spark, d), ["id", "title", "difficulty"])


@register("suggest_titles", with_ctes(TDOCS_CTE) + """
SELECT id, title FROM tdocs WHERE starts_with(lower(title), 'th') ORDER BY title, id LIMIT 5""")
def suggest_titles(spark, d):
    return S.suggest(B.text_documents(spark, d), "th", 5).select("id", "title")


@register("stored_suggest_titles", with_ctes(TDOCS_CTE) + """
SELECT id, title FROM tdocs WHERE starts_with(lower(title), 'th') ORDER BY title, id LIMIT 5""")
def stored_suggest_titles(spark, d):
    """S34 from a table of the first titles of each prefix."""
    path = f"{ensure_checkpoint_dir(spark)}/suggest-{uuid.uuid4().hex}"
    NM.write_suggestions(NM.suggestions(B.text_documents(spark, d)), path)
    return NM.suggest_stored(spark, path, "Th", 5)


@register("any_field_search", with_ctes(TDOCS_CTE, *sql_bm25("a0", "tdocs", "title", "fr des"),
                                        *sql_bm25("a1", "tdocs", "description", "fr des"), """
kw AS (SELECT id, 1.0 AS score FROM tdocs WHERE lang IN ('fr', 'des') UNION ALL
       SELECT id, 1.0 AS score FROM tdocs WHERE source IN ('fr', 'des')),
allsc AS (SELECT id, score FROM a0_sc UNION ALL SELECT id, score FROM a1_sc UNION ALL SELECT id, score FROM kw),
best AS (SELECT id, max(score) AS score FROM allsc GROUP BY id)""") + """
SELECT id, round(score, 6) AS score FROM best ORDER BY score DESC, id LIMIT 10""")
def any_field_search(spark, d):
    return _scores(S.any_field(B.text_documents(spark, d), "fr des", ("title", "description"), ("lang", "source"), 10))


def sql_porter2(words: str) -> list[str]:
    """CTEs from ``words(word)`` to ``stems(word, stem)``: the Porter2 steps, one after the other, on distinct words."""
    vowel, other = ST.VOWEL, ST.OTHER

    def rules(pairs, after, at) -> str:
        cases = []
        for s, new in sorted(pairs, key=lambda r: -len(r[0])):
            more = f" AND regexp_matches(left(w, length(w) - {len(s)}), '{after[s]}')" if s in after else ""
            cases.append(f"WHEN suffix(w, '{s}') THEN CASE WHEN length(w) - {len(s)} >= {at(s)}{more} THEN left(w, length(w) - {len(s)}) || '{new}' ELSE w END")
        return f"CASE {' '.join(cases)} ELSE w END"

    def cut(n: int) -> str:
        return f"left(w, length(w) - {n})"

    def without(s: str) -> str:
        return f"WHEN suffix(w, '{s}') THEN CASE WHEN regexp_matches({cut(len(s))}, '{vowel}') THEN {cut(len(s))} || '|' ELSE w END"

    def eed(s: str) -> str:
        return f"WHEN suffix(w, '{s}') THEN CASE WHEN length(w) - {len(s)} >= r1 THEN {cut(len(s))} || 'ee' ELSE w END"

    first = "|".join([*ST.R1_WORDS, f"{other}*{vowel}+{other}"])
    steps = [
        f"""CASE WHEN suffix(w, 'sses') THEN {cut(2)} WHEN suffix(w, 'ied') OR suffix(w, 'ies') THEN CASE WHEN length(w) > 4 THEN {cut(2)} ELSE {cut(1)} END
            WHEN suffix(w, 'us') OR suffix(w, 'ss') OR NOT suffix(w, 's') THEN w WHEN regexp_matches({cut(2)}, '{vowel}') THEN {cut(1)} ELSE w END""",
        f"CASE {eed('eedly')} {eed('eed')} {without('ingly')} {without('edly')} {without('ing')} {without('ed')} ELSE w END",
        f"""CASE WHEN NOT suffix(w, '|') THEN w WHEN regexp_matches({cut(1)}, '(at|bl|iz)$') THEN {cut(1)} || 'e' WHEN regexp_matches({cut(1)}, '{ST.DOUBLES}') THEN {cut(2)}
            WHEN length(w) - 1 <= r1 AND regexp_matches({cut(1)}, '{ST.SHORT}') THEN {cut(1)} || 'e' ELSE {cut(1)} END""",
        f"CASE WHEN regexp_matches(w, '^.+{other}[yY]$') THEN {cut(1)} || 'i' ELSE w END",
        rules(ST.STEP_2, ST.STEP_2_AFTER, lambda s: "r1"), rules(ST.STEP_3, {}, lambda s: "r2" if s == "ative" else "r1"),
        rules([(s, "") for s in ST.STEP_4], ST.STEP_4_AFTER, lambda s: "r2"),
        f"""CASE WHEN (suffix(w, 'e') AND (length(w) - 1 >= r2 OR (length(w) - 1 >= r1 AND NOT regexp_matches({cut(1)}, '{ST.SHORT}')))) OR
            (suffix(w, 'll') AND length(w) - 1 >= r2) THEN {cut(1)} ELSE w END"""]
    ctes = [f"p0 AS (SELECT word, regexp_replace(word, '(^|{vowel})y', '\\1Y', 'g') AS w FROM {words})",
            f"p1 AS (SELECT word, w, CASE WHEN x = '' THEN length(w) ELSE length(x) END AS r1 FROM (SELECT *, regexp_extract(w, '^({first})', 1) AS x FROM p0))",
            f"p2 AS (SELECT word, w, r1, CASE WHEN x = '' THEN length(w) ELSE r1 + length(x) END AS r2 "
            f"FROM (SELECT *, regexp_extract(substr(w, r1 + 1), '^({other}*{vowel}+{other})', 1) AS x FROM p1))"]
    for i, step in enumerate(steps):
        kept = "w AS a" if i == 1 else "NULL AS a" if i == 0 else "a"
        ctes.append(f"p{i + 3} AS (SELECT word, {step} AS w, r1, r2, {kept} FROM p{i + 2})")
    special = " ".join(f"WHEN word = '{k}' THEN '{v}'" for k, v in ST.SPECIAL.items())
    ctes.append(f"stems AS (SELECT word, CASE WHEN length(word) <= 2 THEN word {special} WHEN a IN ({', '.join(repr(x) for x in ST.SPECIAL_1A)}) THEN a "
                f"ELSE replace(w, 'Y', 'y') END AS stem FROM p{len(steps) + 2})")
    return ctes


def _ranked_sql(query: str, normalization: int) -> str:
    length = {0: "1", 1: "(1 + ln(any_value(dl)))", 2: "any_value(dl)"}[normalization]
    text = "concat_ws(' ', coalesce(title, ''), coalesce(description, ''))"
    return with_ctes(TDOCS_CTE, f"tk AS (SELECT id, {sql_tokens(text, False)} AS toks FROM tdocs)",
                     f"qw AS (SELECT unnest({sql_tokens(sql_lit(query), False)}) AS word)",
                     "words AS (SELECT DISTINCT word FROM (SELECT unnest(toks) AS word FROM tk UNION ALL SELECT word FROM qw))", *sql_porter2("words"),
                     "q AS (SELECT DISTINCT stem FROM qw JOIN stems USING (word))", """
tf AS (SELECT t.id, any_value(t.dl) AS dl, s.stem, count(*) AS tf FROM (SELECT id, len(toks) AS dl, unnest(toks) AS word FROM tk) t JOIN stems s USING (word)
       WHERE s.stem IN (SELECT stem FROM q) GROUP BY t.id, s.stem)""") + f"""
SELECT id, round(sum(0.1 * list_sum(list_transform(range(1, tf + 1), lambda j: 1.0 / (j * j))) / {RANK_SCALE}) / count(*) / {length}, 9) AS rank
FROM tf GROUP BY id HAVING count(*) = (SELECT count(*) FROM q) ORDER BY rank DESC, id LIMIT 50"""


@register("text_search_documents", _ranked_sql("orantions hehely", 0))
def text_search_documents(spark, d):
    return text_search(B.text_documents(spark, d), "orantions hehely", ("title", "description"), 50).select("id", "rank")


@register("text_search_by_length", _ranked_sql("pour ques", 1))
def text_search_by_length(spark, d):
    return text_search(B.text_documents(spark, d), "pour ques", ("title", "description"), 50, normalization=1).select("id", "rank")


@register("stem_documents", with_ctes(TDOCS_CTE, f"words AS (SELECT DISTINCT unnest({sql_tokens('text', False)}) AS word FROM tdocs)", *sql_porter2("words"))
          + "\nSELECT word, stem FROM stems")
def stem_documents(spark, d):
    """Every word of the documents and its Porter2 stem."""
    words = B.text_documents(spark, d).select(F.explode(tokens_col("text")).alias("word")).distinct()
    return porter2_rows(words.withColumn("stem", F.col("word")), "stem")
