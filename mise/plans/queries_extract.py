"""Registered text-to-structure (B) queries over ``documents`` and lines synthesised from the
star tables (the expected values on the SQL side are computed from the source columns, not by
re-parsing)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import metadata as MD
from ..functions import numbers as NB
from ..functions import records as RC
from ..functions import text as TX
from ..functions.ingredients import _POST_SKIP, parse_ingredient_line
from ..session import spread
from . import bindings as B
from .catalog import MENTIONS_CTE, DISHES_CTE, register, with_ctes
from .queries_search import TDOCS_CTE, sql_lit

_PTYPES = ["standard", "economy", "promo", "small", "large", "medium"]


def _synth_lines(spark, d):
    li = B.table(spark, d, "lineitem")
    p = B.table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    q = F.floor("l_quantity").cast("string")
    q1 = (F.floor("l_quantity") + 1).cast("string")
    t = F.lower("p_type")
    line = (F.when(F.col("l_linenumber") == 1,
                   F.concat(q, F.lit("-"), q1, F.lit(" "), t, F.lit(" "), F.col("p_name"), F.lit(" ("),
                            F.col("l_returnflag"), F.lit(")")))
             .when(F.col("l_linenumber") == 2, F.concat(F.lit("1/"), q, F.lit(" "), t, F.lit(". "), F.col("p_name")))
             .otherwise(F.concat(q, F.lit(" "), t, F.lit(" "), F.col("p_name"))))
    return spread(li.join(p, li["l_partkey"] == p["p_partkey"]), "l_orderkey").select(line.alias("line"))


@register("parse_ingredient_lines", """
WITH x AS (
  SELECT lower(p.p_type) AS unit, p.p_name AS name,
         CASE WHEN l.l_linenumber = 1 THEN CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR) || '-' ||
                                            CAST(CAST(floor(l.l_quantity) AS BIGINT) + 1 AS VARCHAR)
              WHEN l.l_linenumber = 2 THEN '1/' || CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR)
              ELSE CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR) END AS quantity,
         CASE WHEN l.l_linenumber = 1 THEN l.l_returnflag END AS notes
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT unit, quantity, name, notes, count(*) AS count FROM x GROUP BY ALL""")
def parse_ingredient_lines(spark, d):
    parsed = _synth_lines(spark, d).select(parse_ingredient_line(F.col("line"), "line", _PTYPES).alias("p"))
    return parsed.groupBy(F.col("p.unit").alias("unit"), F.col("p.quantity").alias("quantity"),
                          F.col("p.name").alias("name"), F.col("p.notes").alias("notes")).agg(
        F.count(F.lit(1)).alias("count"))


def _num_input():
    return (F.when(F.col("l_linenumber") % 3 == 0,
                   F.concat(F.floor("l_quantity").cast("string"), F.lit("-"),
                            (F.floor("l_quantity") + 2).cast("string"), F.lit(" minutes")))
             .when(F.col("l_linenumber") % 3 == 1, F.concat(F.floor("l_quantity").cast("string"), F.lit(".5")))
             .otherwise(F.concat(F.lit("about "), F.floor("l_quantity").cast("string"))))


@register("numbers_from_text", """
SELECT l_linenumber % 3 AS kind, count(*) AS n,
       round(sum(CASE WHEN l_linenumber % 3 = 1 THEN floor(l_quantity) + 0.5 ELSE floor(l_quantity) END), 6) AS total,
       sum(CASE WHEN l_linenumber % 3 = 1 THEN floor(l_quantity) + 1 ELSE floor(l_quantity) END) AS total_int,
       round(sum(1.0 / floor(l_quantity)), 6) AS total_fraction
FROM lineitem GROUP BY 1""")
def numbers_from_text(spark, d):
    li = B.table(spark, d, "lineitem").select("l_linenumber", "l_quantity", _num_input().alias("s"))
    frac = F.concat(F.lit("1/"), F.floor("l_quantity").cast("string"))
    return li.groupBy((F.col("l_linenumber") % 3).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(NB.to_number_col("s")), 6).alias("total"),
        F.sum(NB.to_integer_col("s")).cast("double").alias("total_int"),
        F.round(F.sum(NB.to_number_col(frac, fractions=True)), 6).alias("total_fraction"))


def _case_contains(x: str, table) -> str:
    parts = []
    for value, words in table:
        cond = " OR ".join(f"contains({x}, '{w}')" for w in words)
        parts.append(f"WHEN {cond} THEN '{value}'")
    return "CASE " + " ".join(parts) + " END"


_DIFF_IN = ("lower(o_orderpriority) || ' ' || lower(CASE o_orderstatus WHEN 'F' THEN 'Super Easy' "
            "WHEN 'O' THEN 'Moderate' ELSE 'challenging' END)")
_MEAL_IN = ("lower(lower(substr(o_orderpriority, 3)) || ' ' || CASE o_orderstatus WHEN 'F' THEN 'Dinner or lunch' "
            "WHEN 'O' THEN 'brunch' ELSE 'main' END)")


@register("normalize_categories", f"""
SELECT o_orderkey AS id, {_case_contains(_DIFF_IN, lx.DIFFICULTY_SYNONYMS)} AS difficulty,
       {_case_contains(_MEAL_IN, lx.MEAL_SYNONYMS)} AS meal_type FROM orders""")
def normalize_categories(spark, d):
    o = B.table(spark, d, "orders")
    diff = F.concat(F.col("o_orderpriority"), F.lit(" "),
                    F.when(F.col("o_orderstatus") == "F", "Super Easy").when(F.col("o_orderstatus") == "O", "Moderate")
                     .otherwise("challenging"))
    meal = F.concat(F.lower(F.expr("substring(o_orderpriority, 3)")), F.lit(" "),
                    F.when(F.col("o_orderstatus") == "F", "Dinner or lunch").when(F.col("o_orderstatus") == "O", "brunch")
                     .otherwise("main"))
    return o.select(F.col("o_orderkey").alias("id"),
                    NB.normalize_by_synonyms_col(diff, lx.DIFFICULTY_SYNONYMS).alias("difficulty"),
                    NB.normalize_by_synonyms_col(meal, lx.MEAL_SYNONYMS).alias("meal_type"))


_RENDER_SQL = with_ctes(DISHES_CTE, MENTIONS_CTE, """
pos AS (SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY order_index, l_partkey, l_suppkey, l_quantity,
                                                                   l_extendedprice) AS k FROM mentions)""") + """
SELECT r.id, md5(coalesce(string_agg(CAST(p.k AS VARCHAR) || '. ' || p.name, chr(10) ORDER BY p.k), '')) AS text_md5
FROM dishes r LEFT JOIN pos p ON r.id = p.id GROUP BY r.id"""


@register("render_ingredient_text", _RENDER_SQL)
def render_ingredient_text(spark, d):
    docs = B.documents(spark, d)
    return docs.select("id", F.md5(TX.render_text_col(F.transform("ingredients", lambda e: e["name"]))).alias("text_md5"))


@register("ingredient_labels", with_ctes(DISHES_CTE, MENTIONS_CTE, """
lab AS (SELECT m.id, m.order_index, m.l_partkey, m.l_suppkey, m.l_quantity, m.l_extendedprice,
               trim(concat_ws(' ', CAST(m.l_quantity AS VARCHAR), s.s_name, m.name)) AS label
        FROM mentions m JOIN supplier s ON m.l_suppkey = s.s_suppkey)""") + """
SELECT r.id, md5(coalesce(string_agg(label, '|' ORDER BY order_index, l_partkey, l_suppkey, l_quantity,
                                     l_extendedprice), '')) AS labels_md5
FROM dishes r LEFT JOIN lab ON r.id = lab.id GROUP BY r.id""")
def ingredient_labels(spark, d):
    docs = TX.ingredient_labels(B.documents(spark, d))
    return docs.select("id", F.md5(F.array_join("labels", "|")).alias("labels_md5"))


@register("decode_json_cells", with_ctes(DISHES_CTE, MENTIONS_CTE) + """
SELECT r.id,
       CASE WHEN o.o_orderstatus = 'P' THEN 1 ELSE count(m.name) END AS n,
       CASE WHEN o.o_orderstatus = 'P' THEN 'not json ' || CAST(r.id AS VARCHAR)
            ELSE coalesce(string_agg(m.name, '|' ORDER BY m.order_index, m.l_partkey, m.l_suppkey, m.l_quantity,
                                     m.l_extendedprice), '') END AS joined
FROM dishes r JOIN orders o ON r.id = o.o_orderkey LEFT JOIN mentions m ON r.id = m.id
GROUP BY r.id, o.o_orderstatus""")
def decode_json_cells(spark, d):
    docs = B.documents(spark, d)
    cell = F.when(F.col("difficulty") == "P", F.concat(F.lit("not json "), F.col("id").cast("string"))) \
            .otherwise(F.to_json(F.transform("ingredients", lambda e: e["name"])))
    dec = docs.select("id", TX.decode_json_array_col(cell).alias("a"))
    return dec.select("id", F.size("a").cast("bigint").alias("n"), F.array_join("a", "|").alias("joined"))


@register("split_title_lists", with_ctes(TDOCS_CTE) + """
SELECT id, CAST(len(list_filter(list_transform(regexp_split_to_array(title, '[,;|\n]'),
                                               lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')),
                                lambda x: x <> '')) AS INTEGER) AS n_items FROM tdocs""")
def split_title_lists(spark, d):
    return B.text_documents(spark, d).select("id", F.size(TX.split_list_col("title")).alias("n_items"))


_FIRST_KW = ["zzz", "der", "les", "the"]
_ALL_KW = ["que", "und", "the", "tion"]
_GROUPS = [("g1", ["zzz"]), ("g2", ["und", "der"]), ("g3", ["the"])]


def _first_kw_sql(x, kws):
    return "CASE " + " ".join(f"WHEN contains({x}, '{k}') THEN '{k}'" for k in kws) + " END"


@register("document_keywords", f"""
SELECT doc_id AS id, {_first_kw_sql('lower(text)', _FIRST_KW)} AS first_keyword,
       nullif(array_to_string(list_filter({[k for k in _ALL_KW]}, lambda k: contains(lower(text), k)), '|'), '')
         AS keywords,
       {_case_contains('lower(text)', _GROUPS)} AS grp
FROM documents""")
def document_keywords(spark, d):
    t = B.table(spark, d, "documents")
    return t.select(F.col("doc_id").alias("id"), MD.first_keyword_col("text", _FIRST_KW).alias("first_keyword"),
                    F.array_join(MD.all_keywords_col("text", _ALL_KW), "|").alias("keywords"),
                    MD.classify_by_groups_col("text", _GROUPS).alias("grp"))


def _cascade_sql(x, patterns):
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({x}, {sql_lit(p)}, 1), '')" for p in patterns) + ")"


@register("document_metadata", f"""
SELECT doc_id AS id,
       {_cascade_sql('lower(text)', lx.SERVINGS_PATTERNS)} AS servings_raw,
       {_cascade_sql('lower(text)', lx.PREP_PATTERNS)} AS prep_time,
       {_cascade_sql('lower(text)', lx.COOK_PATTERNS)} AS cook_time,
       {_cascade_sql('lower(text)', lx.TOTAL_PATTERNS)} AS total_time
FROM documents""")
def document_metadata(spark, d):
    t = B.table(spark, d, "documents")
    low = F.lower("text")
    times = MD.times_col("text", infer=False)
    return t.select(F.col("doc_id").alias("id"), TX.first_match(low, lx.SERVINGS_PATTERNS).alias("servings_raw"),
                    times["prepTime"].alias("prep_time"), times["cookTime"].alias("cook_time"),
                    times["totalTime"].alias("total_time"))


_HEADERS = (("ingredients", r"^(the|der)"), ("instructions", r"^(de|le|la|die)"))


def _sections_sql(headers) -> str:
    cleaned = ("regexp_replace(regexp_replace(regexp_replace(lower(line), '^\\s+|\\s+$', '', 'g'), "
               "'[*#\\-_:]', '', 'g'), '^\\s+|\\s+$', '', 'g')")
    hdr = "CASE " + " ".join(f"WHEN regexp_matches({cleaned}, {sql_lit(p)}) THEN '{n}'" for n, p in headers) + " END"
    return f"""
ln AS (SELECT doc_id AS id, unnest(string_split(text, chr(10))) AS line,
              generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
hd AS (SELECT id, pos, line, {hdr} AS hdr FROM ln),
tg AS (SELECT id, pos, line, CASE WHEN hdr IS NOT NULL THEN 'header'
               ELSE coalesce(last_value(hdr IGNORE NULLS) OVER (PARTITION BY id ORDER BY pos
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'general') END AS tag FROM hd),
cnt AS (SELECT id, count(*) FILTER (WHERE tag = 'general') AS g, count(*) FILTER (WHERE tag = 'ingredients') AS i,
               count(*) FILTER (WHERE tag = 'instructions') AS s,
               count(*) FILTER (WHERE regexp_matches(regexp_replace(line, '^\\s+|\\s+$', '', 'g'),
                                                     {sql_lit(lx.MEASURE_LINE)})) AS mi,
               count(*) FILTER (WHERE NOT regexp_matches(regexp_replace(line, '^\\s+|\\s+$', '', 'g'),
                                                         {sql_lit(lx.MEASURE_LINE)})
                                  AND regexp_matches(regexp_replace(line, '^\\s+|\\s+$', '', 'g'),
                                                     {sql_lit(lx.VERB_LINE)})) AS vi
        FROM tg GROUP BY id)"""


@register("split_document_sections", "WITH " + _sections_sql(_HEADERS) + """
SELECT id, CAST(g AS INTEGER) AS n_general,
       CAST(CASE WHEN i = 0 AND s = 0 THEN mi ELSE i END AS INTEGER) AS n_ingredients,
       CAST(CASE WHEN i = 0 AND s = 0 THEN vi ELSE s END AS INTEGER) AS n_instructions FROM cnt""")
def split_document_sections(spark, d):
    t = B.table(spark, d, "documents")
    s = t.select(F.col("doc_id").alias("id"), TX.split_sections_col("text", _HEADERS).alias("s"))
    return s.select("id", F.size("s.general").alias("n_general"), F.size("s.ingredients").alias("n_ingredients"),
                    F.size("s.instructions").alias("n_instructions"))


_CLEAN = ("regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
          "regexp_replace(x, '^\\s+|\\s+$', '', 'g'), '^\\d+\\.?\\s*', ''), '^[*\\-+•]\\s*', ''), "
          "'\\*\\*(.*?)\\*\\*', '\\1', 'g'), '\\*(.*?)\\*', '\\1', 'g'), '~~(.*?)~~', '\\1', 'g'), "
          "'^\\*+|\\*+$', '', 'g')")


@register("clean_document_lines", f"""
SELECT doc_id AS id, CAST(len(c) AS INTEGER) AS n_steps, md5(array_to_string(c, chr(10))) AS steps_md5 FROM (
  SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)),
                                            lambda x: regexp_replace({_CLEAN}, '^\\s+|\\s+$', '', 'g')),
                             lambda y: length(y) > 10) AS c
  FROM documents)""")
def clean_document_lines(spark, d):
    t = B.table(spark, d, "documents")
    c = t.select(F.col("doc_id").alias("id"), TX.clean_instructions_col(TX.lines_of("text"), "post").alias("c"))
    return c.select("id", F.size("c").alias("n_steps"), F.md5(F.array_join("c", "\n")).alias("steps_md5"))


def _post_sql(counts: bool = False) -> str:
    """DuckDB form of the post pipeline's scalar fields and step count (default headers); with
    ``counts`` the per-language extraction counts (B31) instead."""
    low = "lower(text)"
    servings_found = _cascade_sql(low, lx.SERVINGS_PATTERNS)
    hints = []
    for words, value in lx.SERVINGS_HINTS:
        cond = " OR ".join(f"contains({low}, '{w}')" for w in words)
        if value == "pieces":
            v = (f"CAST(TRY_CAST(nullif(regexp_extract({low}, {sql_lit(lx.PIECES_PATTERN)}, 1), '') AS BIGINT) "
                 f"AS VARCHAR)")
        else:
            v = f"'{value}'"
        hints.append(f"WHEN {cond} THEN {v}")
    servings = (f"CASE WHEN {servings_found} IS NOT NULL THEN CASE WHEN contains({servings_found}, '-') THEN "
                f"{servings_found} ELSE CAST(TRY_CAST({servings_found} AS BIGINT) AS VARCHAR) END "
                + " ".join(hints) + " END")
    prep_guess = "CASE " + " ".join(
        "WHEN " + " OR ".join(f"contains({low}, '{w}')" for w in words) + f" THEN '{v}'"
        for words, v in lx.PREP_HINTS) + " END"
    labelled = f"lower({_cascade_sql(low, lx.DIFFICULTY_PATTERNS)})"
    hint = ("CASE WHEN " + " OR ".join(f"contains({low}, '{w}')" for w in lx.EASY_HINTS) + " THEN 'easy' WHEN "
            + " OR ".join(f"contains({low}, '{w}')" for w in lx.HARD_HINTS) + " THEN 'hard' END")
    override = " OR ".join(f"contains({low}, '{w}')" for w in lx.MEDIUM_OVERRIDES)
    difficulty = f"CASE WHEN {override} THEN 'medium' ELSE coalesce({labelled}, {hint}) END"
    dietary = f"list_filter({[k for k in lx.DIETARY]}, lambda k: contains({low}, k))"
    excl = " AND ".join(f"NOT contains(lower(t), '{w}')" for w in lx.DESCRIPTION_EXCLUDES)
    ctes = "WITH " + _sections_sql(TX.DEFAULT_HEADERS) + f""",
tl AS (SELECT id, pos, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS t FROM ln),
d1 AS (SELECT id, arg_min(t, pos) AS d FROM tl
       WHERE length(t) > 30 AND {excl} AND NOT regexp_matches(t, '^\\d+\\.')
         AND NOT starts_with(t, '**') AND NOT starts_with(t, '-') GROUP BY id),
gen AS (SELECT id, nullif(substr(regexp_replace(string_agg(line, ' ' ORDER BY pos), '^\\s+|\\s+$', '', 'g'), 1, 500), '')
               AS g
        FROM (SELECT id, pos, line, row_number() OVER (PARTITION BY id ORDER BY pos) AS k FROM tg WHERE tag = 'general')
        WHERE k <= 3 GROUP BY id),
steps AS (SELECT t.id, count(*) FILTER (WHERE length(regexp_replace({_CLEAN.replace('(x,', '(t.line,')},
                                                             '^\\s+|\\s+$', '', 'g')) > 10) AS n
          FROM tg t JOIN cnt c ON t.id = c.id
          WHERE CASE WHEN c.i = 0 AND c.s = 0 THEN NOT regexp_matches(regexp_replace(t.line, '^\\s+|\\s+$', '', 'g'),
                                                                      {sql_lit(lx.MEASURE_LINE)})
                                                 AND regexp_matches(regexp_replace(t.line, '^\\s+|\\s+$', '', 'g'),
                                                                    {sql_lit(lx.VERB_LINE)})
                     ELSE t.tag = 'instructions' END
          GROUP BY t.id)"""
    if counts:
        return ctes + f""",
ing AS (SELECT t.id, count(*) FILTER (WHERE length(t.tl) >= 3 AND NOT regexp_matches(t.tl, {sql_lit(_POST_SKIP)}))
               AS n
        FROM (SELECT id, tag, line, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS tl FROM tg) t
        JOIN cnt c ON t.id = c.id
        WHERE CASE WHEN c.i = 0 AND c.s = 0 THEN regexp_matches(t.tl, {sql_lit(lx.MEASURE_LINE)})
                   ELSE t.tag = 'ingredients' END
        GROUP BY t.id),
per AS (SELECT doc.lang AS dataset, coalesce(ing.n, 0) AS n_ing, coalesce(steps.n, 0) AS n_ins
        FROM documents doc LEFT JOIN ing ON doc.doc_id = ing.id LEFT JOIN steps ON doc.doc_id = steps.id)
SELECT dataset, count(*) AS entries, sum(n_ing) AS ingredients_found, sum(n_ins) AS steps_found,
       round(avg(n_ing), 6) AS avg_ingredients, round(avg(n_ins), 6) AS avg_steps,
       count(*) FILTER (WHERE n_ing = 0) AS without_ingredients, count(*) FILTER (WHERE n_ins = 0) AS without_steps
FROM per GROUP BY dataset"""
    return ctes + f"""
SELECT doc.doc_id AS id, doc.lang, coalesce(d1.d, gen.g) AS description,
       CAST(coalesce(steps.n, 0) AS INTEGER) AS n_steps,
       {servings} AS servings,
       coalesce({_cascade_sql(low, lx.PREP_PATTERNS)}, {prep_guess}) AS prep_time,
       {_cascade_sql(low, lx.COOK_PATTERNS)} AS cook_time,
       {_cascade_sql(low, lx.TOTAL_PATTERNS)} AS total_time,
       {difficulty} AS difficulty,
       {_first_kw_sql(low, lx.CUISINES)} AS cuisine,
       {_first_kw_sql(low, lx.COURSES)} AS course,
       coalesce({_first_kw_sql(low, lx.MEALS)}, {_case_contains(low, lx.MEAL_GROUPS)}) AS meal_type,
       nullif(array_to_string({dietary}, '|'), '') AS dietary_tags
FROM documents doc LEFT JOIN d1 ON doc.doc_id = d1.id LEFT JOIN gen ON doc.doc_id = gen.id
LEFT JOIN steps ON doc.doc_id = steps.id"""


@register("extract_posts_documents", _post_sql())
def extract_posts_documents(spark, d):
    """B17 over whole documents (text as the post, first line as the title)."""
    t = B.table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang", "text",
                                              F.substring_index("text", "\n", 1).alias("title"))
    r = RC.extract_posts(t, "text", "title").select("id", "lang", "dish.*")
    return r.select("id", "lang", "description", F.size("instructions").alias("n_steps"), "servings",
                    F.col("prepTime").alias("prep_time"), F.col("cookTime").alias("cook_time"),
                    F.col("totalTime").alias("total_time"), "difficulty", "cuisine", "course",
                    F.col("mealType").alias("meal_type"), F.array_join("dietaryTags", "|").alias("dietary_tags"))


@register("extract_structured_orders", with_ctes(DISHES_CTE, MENTIONS_CTE, """
per AS (SELECT id, count(*) AS n FROM mentions GROUP BY id)""") + """
SELECT r.id, coalesce(p.n, 0) AS n_ingredients, CAST(r.total_time_minutes AS VARCHAR) || ' min' AS cook_time,
       CAST((r.id % 6) + 1 AS VARCHAR) AS servings, 2 AS n_steps
FROM dishes r LEFT JOIN per p ON r.id = p.id""")
def extract_structured_orders(spark, d):
    """B18 over JSON-array cells built per order: ingredient lines and two directions."""
    docs = B.documents(spark, d)
    ing = F.to_json(F.transform("ingredients", lambda e: F.concat(e["quantity"].cast("string"), F.lit(" "),
                                                                   e["unit"], F.lit(" "), e["name"])))
    dirs = F.to_json(F.array(
        F.concat(F.lit("Cook time: "), F.col("total_time_minutes").cast("string"), F.lit(" minutes, until done.")),
        F.concat(F.lit("Serves "), ((F.col("id") % 6) + 1).cast("string"), F.lit(" as a main dish."))))
    rows = docs.select("id", "title", ing.alias("ingredients"), dirs.alias("directions"))
    out = RC.extract_structured(rows)
    return out.select("id", F.size("dish.ingredients").cast("bigint").alias("n_ingredients"),
                      F.col("dish.cookTime").alias("cook_time"), F.col("dish.servings").alias("servings"),
                      F.size("dish.instructions").alias("n_steps"))


def extraction_counts_by_lang(spark, d):
    """B31 over the B17 output of ``documents``."""
    t = B.text_documents(spark, d).withColumnRenamed("lang", "dataset")
    return RC.extraction_counts(RC.extract_posts(t, "text", "title", out="recipeData"), "dataset")


register("extraction_counts_by_lang", _post_sql(counts=True))(extraction_counts_by_lang)


def coerce_event_props(spark, d):
    """B24 / B25 over the JSON cells of ``events`` (objects without dish fields)."""
    e = B.table(spark, d, "events")
    return e.select("event_id", RC.coerce_records_col("props").alias("r"),
                    F.array_join(RC.validation_errors_col("props"), ",").alias("errors")).select(
        "event_id", "r.title", "r.ingredients", "errors")


register("coerce_event_props", """
SELECT event_id, NULL AS title, NULL AS ingredients,
       'title,ingredients.type,ingredients.min,instructions.type,instructions.min' AS errors
FROM events""")(coerce_event_props)


def _json_records(spark, d):
    """One JSON record per order: well typed (status F), wrongly typed (O) or strict-shaped (P)."""
    docs = B.documents(spark, d)
    ings_f = F.to_json(F.transform("ingredients", lambda e: F.struct(e["name"].alias("name"),
                                                                      e["quantity"].alias("quantity"))))
    ings_p = F.to_json(F.transform("ingredients", lambda e: F.struct(
        e["name"].alias("item"), F.concat(e["quantity"].cast("int").cast("string"), F.lit(" cup")).alias("amount"))))
    idc = F.col("id").cast("string")
    rec = (F.when(F.col("difficulty") == "F",
                  F.concat(F.lit('{"title":"order '), idc, F.lit('","ingredients":'), ings_f,
                           F.lit(',"instructions":["Mix well"],"prepTime":'),
                           F.col("total_time_minutes").cast("string"), F.lit("}")))
            .when(F.col("difficulty") == "O",
                  F.concat(F.lit('{"title":'), idc, F.lit(',"ingredients":"none","instructions":[1,2],'
                                                          '"servings":"2-4"}')))
            .otherwise(F.concat(F.lit('{"title":"t'), idc, F.lit('","ingredients":'), ings_p,
                                F.lit(',"instructions":[{"step":1,"title":"Mix","description":"Mix it"}]}'))))
    return docs.select("id", rec.alias("json"))


_ERR_F = "'instructions.step,instructions.title,instructions.description,prepTime'"


@register("coerce_json_records", with_ctes(DISHES_CTE, MENTIONS_CTE, """
per AS (SELECT id, count(*) AS n,
               string_agg(CASE WHEN l_quantity = floor(l_quantity) THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
                               ELSE CAST(l_quantity AS VARCHAR) END, '|'
                          ORDER BY order_index, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS q
        FROM mentions GROUP BY id)""") + f"""
SELECT r.id,
       CASE r.difficulty WHEN 'F' THEN 'order ' || CAST(r.id AS VARCHAR) WHEN 'O' THEN 'Untitled Recipe'
            ELSE 't' || CAST(r.id AS VARCHAR) END AS title,
       CASE WHEN r.difficulty = 'O' THEN 0 ELSE coalesce(p.n, 0) END AS n_ingredients,
       CASE WHEN r.difficulty = 'F' THEN coalesce(p.q, '') ELSE '' END AS quantities,
       CASE WHEN r.difficulty = 'F' THEN 1 ELSE 0 END AS n_instructions,
       CASE WHEN r.difficulty = 'F' THEN CAST(r.total_time_minutes AS VARCHAR) END AS prep_time,
       CASE WHEN r.difficulty = 'O' THEN '2-4' END AS servings,
       CASE WHEN r.difficulty = 'F' THEN
              CASE WHEN p.n IS NULL THEN 'ingredients.min,' || {_ERR_F}
                   ELSE 'ingredients.item,ingredients.amount,' || {_ERR_F} END
            WHEN r.difficulty = 'O' THEN
              'title,ingredients.type,ingredients.min,instructions.step,instructions.title,instructions.description'
            ELSE CASE WHEN p.n IS NULL THEN 'ingredients.min' ELSE '' END END AS errors
FROM dishes r LEFT JOIN per p ON r.id = p.id""")
def coerce_json_records(spark, d):
    # Parsed in a projection of its own: every field and rule reads it.
    j = _json_records(spark, d).select("id", F.try_parse_json("json").alias("v"))
    r = j.select("id", RC.coerce_records_col("v", parsed=True).alias("r"),
                 F.array_join(RC.validation_errors_col("v", parsed=True), ",").alias("errors"))
    return r.select("id", F.col("r.title").alias("title"), F.size("r.ingredients").cast("bigint").alias("n_ingredients"),
                    F.array_join(F.transform("r.ingredients", lambda e: e["quantity"]), "|").alias("quantities"),
                    F.size("r.instructions").alias("n_instructions"), F.col("r.prepTime").alias("prep_time"),
                    F.col("r.servings").alias("servings"), "errors")


@register("extraction_counts_json", with_ctes(DISHES_CTE, MENTIONS_CTE, """
per AS (SELECT id, count(*) AS n FROM mentions GROUP BY id),
x AS (SELECT r.difficulty AS dataset,
             CASE WHEN r.difficulty = 'O' THEN 0 ELSE coalesce(p.n, 0) END AS n_ing,
             CASE WHEN r.difficulty = 'F' THEN 1 ELSE 0 END AS n_ins
      FROM dishes r LEFT JOIN per p ON r.id = p.id)""") + """
SELECT dataset, count(*) AS entries, sum(n_ing) AS ingredients_found, sum(n_ins) AS steps_found,
       round(avg(n_ing), 6) AS avg_ingredients, round(avg(n_ins), 6) AS avg_steps,
       count(*) FILTER (WHERE n_ing = 0) AS without_ingredients, count(*) FILTER (WHERE n_ins = 0) AS without_steps
FROM x GROUP BY dataset""")
def extraction_counts_json(spark, d):
    """B31 over records coerced from per-order JSON (dataset = order status)."""
    j = _json_records(spark, d).join(B.dishes(spark, d).select("id", F.col("difficulty").alias("dataset")), "id")
    return RC.extraction_counts(j.select("dataset", RC.coerce_records_col("json").alias("recipeData")), "dataset")


@register("separator_lines", """
SELECT p.p_name AS amount, CAST(CAST(floor(l.l_quantity) AS BIGINT) AS VARCHAR) || ' pcs' AS name, count(*) AS count
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY ALL""")
def separator_lines(spark, d):
    """B4 (separator style) on synthesised 'name - quantity pcs' lines."""
    from ..functions.ingredients import amount_name
    li = spread(B.table(spark, d, "lineitem"), "l_orderkey")
    p = B.table(spark, d, "part").select("p_partkey", "p_name")
    line = F.concat(F.lit("- "), F.col("p_name"), F.lit(" - "), F.floor("l_quantity").cast("string"), F.lit(" pcs"))
    parsed = li.join(p, li["l_partkey"] == p["p_partkey"]).select(amount_name(line).alias("a"))
    return parsed.groupBy(F.col("a.amount").alias("amount"), F.col("a.name").alias("name")).agg(
        F.count(F.lit(1)).alias("count"))
