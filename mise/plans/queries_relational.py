"""Registered relational (R) and aggregation (G) queries over the star-table binding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as G
from ..operators import relational as R
from . import bindings as B
from .catalog import MENTIONS_CTE, DISHES_CTE, register, with_ctes

# DuckDB version of the document-group ranking used by several G queries.
_TOP_GROUPS = """
top_groups AS (
  SELECT cuisine_type, count(*) AS group_count FROM dishes WHERE cuisine_type IS NOT NULL
  GROUP BY cuisine_type ORDER BY group_count DESC, cuisine_type LIMIT {n})"""


# ---------------------------------------------------------------------------------------- G7
@register("top_ingredients_per_cuisine", with_ctes(DISHES_CTE, MENTIONS_CTE, _TOP_GROUPS.format(n=10), """
counts AS (
  SELECT r.cuisine_type, m.name, count(*) AS count
  FROM mentions m JOIN dishes r ON m.id = r.id
  WHERE r.cuisine_type IN (SELECT cuisine_type FROM top_groups) AND m.name IS NOT NULL
  GROUP BY r.cuisine_type, m.name),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY cuisine_type ORDER BY count DESC, name) AS INTEGER) AS rank
  FROM counts)""") + """
SELECT k.cuisine_type, k.name, k.count, k.rank, g.group_count
FROM ranked k JOIN top_groups g ON k.cuisine_type = g.cuisine_type WHERE k.rank <= 10""")
def top_ingredients_per_cuisine(spark, d):
    return G.top_per_group(B.dishes(spark, d), "cuisine_type", 10, 10, flat=B.mentions(spark, d)).select(
        "cuisine_type", "name", "count", "rank", "group_count")


@register("one_cuisine_ingredients", with_ctes(DISHES_CTE, MENTIONS_CTE, _TOP_GROUPS.format(n=10), """
counts AS (
  SELECT r.cuisine_type, m.name, count(*) AS count
  FROM mentions m JOIN dishes r ON m.id = r.id
  WHERE r.cuisine_type = '2-HIGH' AND r.cuisine_type IN (SELECT cuisine_type FROM top_groups)
    AND m.name IS NOT NULL
  GROUP BY r.cuisine_type, m.name),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY cuisine_type ORDER BY count DESC, name) AS INTEGER) AS rank
  FROM counts)""") + """
SELECT cuisine_type, name, count, rank FROM ranked WHERE rank <= 10""")
def one_cuisine_ingredients(spark, d):
    return G.top_per_group(B.dishes(spark, d), "cuisine_type", 10, 10, only="2-HIGH",
                           flat=B.mentions(spark, d)).select("cuisine_type", "name", "count", "rank")


# ------------------------------------------------------------------------------------- R1 / R2
@register("dish_rows", with_ctes(DISHES_CTE) + """
SELECT r.id, r.title, l.l_linenumber AS order_index, p.p_name AS ingredient_name, s.s_name AS unit_name,
       CAST(l.l_quantity AS DECIMAL(10,3)) AS amount, l.l_returnflag AS notes
FROM dishes r LEFT JOIN lineitem l ON r.id = l.l_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey""")
def dish_rows(spark, d):
    return R.dish_rows(B.dishes(spark, d), B.junction(spark, d), B.ingredients(spark, d),
                         B.measurements(spark, d)).select("id", "title", "order_index", "ingredient_name", "unit_name",
                                                          "amount", "notes")


@register("nested_dishes", with_ctes(DISHES_CTE, MENTIONS_CTE) + """
SELECT r.id, count(m.name) AS n_ingredients,
       coalesce(string_agg(m.name, '|' ORDER BY m.order_index, m.l_partkey, m.l_suppkey, m.l_quantity,
                           m.l_extendedprice), '') AS ingredient_names,
       round(coalesce(sum(m.l_quantity), 0), 6) AS total_quantity
FROM dishes r LEFT JOIN mentions m ON r.id = m.id GROUP BY r.id""")
def nested_dishes(spark, d):
    docs = B.documents(spark, d)
    return docs.select(
        "id", F.size("ingredients").cast("bigint").alias("n_ingredients"),
        F.array_join(F.transform("ingredients", lambda e: e["name"]), "|").alias("ingredient_names"),
        F.round(F.aggregate("ingredients", F.lit(0.0), lambda a, e: a + e["quantity"]), 6).alias("total_quantity"))


@register("search_documents", with_ctes(DISHES_CTE, MENTIONS_CTE) + """
SELECT r.id, r.title, r.cuisine_type, r.difficulty, r.total_time_minutes,
       CAST(r.servings AS DOUBLE) AS servings, r.post_score,
       coalesce(string_agg(m.name || ':' || CAST(m.l_quantity AS VARCHAR), ';' ORDER BY m.order_index, m.l_partkey,
                           m.l_suppkey, m.l_quantity, m.l_extendedprice), '') AS ingredients
FROM dishes r LEFT JOIN mentions m ON r.id = m.id GROUP BY ALL""")
def search_documents(spark, d):
    docs = B.documents(spark, d)
    label = F.transform("ingredients", lambda e: F.concat(e["name"], F.lit(":"), e["quantity"].cast("string")))
    return docs.select("id", "title", "cuisine_type", "difficulty", "total_time_minutes", "servings", "post_score",
                       F.array_join(label, ";").alias("ingredients"))


# ------------------------------------------------------------------------------------ R3 - R10
@register("dishes_by_ids", with_ctes(DISHES_CTE) + """
SELECT id, title, cuisine_type FROM dishes
WHERE id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def dishes_by_ids(spark, d):
    ids = B.table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R").select("l_orderkey")
    return R.by_ids(B.dishes(spark, d), ids).select("id", "title", "cuisine_type")


@register("ingredient_by_name", """
SELECT p_partkey AS id, p_name AS name, p_type AS category FROM part WHERE p_name = 'red widget'""")
def ingredient_by_name(spark, d):
    return R.by_name(B.ingredients(spark, d), "red widget").select("id", "name", "category")


@register("filter_dishes", with_ctes(DISHES_CTE) + """
SELECT id, title FROM dishes r
WHERE cuisine_type = '1-URGENT' AND difficulty = 'F' AND prep_time_minutes <= 60 AND cook_time_minutes <= 150
  AND servings >= 3
  AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = r.id AND l.l_returnflag IN ('R'))""")
def filter_dishes(spark, d):
    r = B.dishes_with_tags(spark, d)
    return R.filter_dishes(r, cuisine_type="1-URGENT", difficulty="F", dietary_tags=["R"], max_prep_time=60,
                            max_cook_time=150, min_servings=3).select("id", "title")


@register("recent_page", with_ctes(DISHES_CTE) + """
SELECT id, created_at FROM dishes ORDER BY created_at DESC, id DESC LIMIT 50 OFFSET 10""")
def recent_page(spark, d):
    return R.page(B.dishes(spark, d), [("created_at", "desc"), ("id", "desc")], 50, 10).select("id", "created_at")


@register("list_ingredients", """
SELECT p_partkey AS id, p_name AS name, p_type AS category FROM part WHERE p_type = 'SMALL'
ORDER BY name, id LIMIT 100""")
def list_ingredients(spark, d):
    return R.list_dimension(B.ingredients(spark, d), category="SMALL").select("id", "name", "category")


@register("ilike_ingredients", """
SELECT p_partkey AS id, p_name AS name FROM part WHERE p_name ILIKE '%WIDGET%' OR p_brand ILIKE '%WIDGET%'""")
def ilike_ingredients(spark, d):
    return R.ilike_search(B.ingredients(spark, d), "WIDGET", ("name", "description")).select("id", "name")


# ----------------------------------------------------------------------------------- R12 - R17
@register("dish_stats", with_ctes(DISHES_CTE) + """
SELECT count(*) AS total_dishes, count(DISTINCT cuisine_type) AS unique_cuisines,
       count(DISTINCT meal_type) AS unique_meal_types,
       round(avg(prep_time_minutes), 6) AS avg_prep_time, round(avg(cook_time_minutes), 6) AS avg_cook_time,
       round(avg(total_time_minutes), 6) AS avg_total_time, round(avg(CAST(servings AS DOUBLE)), 6) AS avg_servings
FROM dishes""")
def dish_stats(spark, d):
    return R.dish_stats(B.dishes(spark, d))


@register("cuisine_facets", with_ctes(DISHES_CTE) + """
SELECT cuisine_type, count(*) AS count FROM dishes GROUP BY cuisine_type""")
def cuisine_facets(spark, d):
    return R.facet_counts(B.dishes(spark, d), "cuisine_type")


@register("recent_dishes", with_ctes(DISHES_CTE) + """
SELECT id, title, created_at FROM dishes ORDER BY created_at DESC, id DESC LIMIT 10""")
def recent_dishes(spark, d):
    return R.recent(B.dishes(spark, d), 10).select("id", "title", "created_at")


@register("events_last_day", """
SELECT count(*) AS count FROM events WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 1 DAY""")
def events_last_day(spark, d):
    return R.count_since(B.table(spark, d, "events"), "ts", "2024-01-30 12:00:00", "1 day")


@register("count_by_source", """
SELECT source, count(*) AS count FROM documents WHERE source LIKE 'src1%' GROUP BY source""")
def count_by_source(spark, d):
    return R.count_by(B.table(spark, d, "documents"), "source", "src1%")


@register("avg_ingredients", with_ctes(DISHES_CTE) + """
SELECT count(*) AS total_dishes, count(DISTINCT r.cuisine_type) AS unique_cuisines,
       round(avg(c.n), 6) AS avg_ingredients_per_dish
FROM dishes r LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) c
  ON r.id = c.l_orderkey""")
def avg_ingredients(spark, d):
    return R.avg_children(B.dishes(spark, d), B.junction(spark, d))


@register("avg_ingredients_with_zero", with_ctes(DISHES_CTE) + """
SELECT count(*) AS total_dishes, count(DISTINCT r.cuisine_type) AS unique_cuisines,
       round(avg(coalesce(c.n, 0)), 6) AS avg_ingredients_per_dish
FROM dishes r LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) c
  ON r.id = c.l_orderkey""")
def avg_ingredients_with_zero(spark, d):
    return R.avg_children(B.dishes(spark, d), B.junction(spark, d), as_zero=True)


# ------------------------------------------------------------------------------------ G1 - G12
@register("cuisine_value_count", with_ctes(DISHES_CTE) + """
SELECT count(cuisine_type) AS value_count FROM dishes""")
def cuisine_value_count(spark, d):
    return G.value_count(B.documents(spark, d), "cuisine_type")


@register("ingredient_cardinality", with_ctes(MENTIONS_CTE) + """
SELECT count(DISTINCT name) AS cardinality FROM mentions""")
def ingredient_cardinality(spark, d):
    return G.cardinality(B.mentions(spark, d, ()), "name", approx=False)


@register("ingredient_cardinality_approx", """
SELECT count(DISTINCT l_orderkey) AS exact, true AS within_tolerance FROM lineitem""")
def ingredient_cardinality_approx(spark, d):
    """The estimate of the dishes with lines against the exact count: within 15 %, three times the
    sketch's standard error of 5 %."""
    lines = B.table(spark, d, "lineitem")
    exact = G.cardinality(lines, "l_orderkey", approx=False).scalar()
    both = G.cardinality(lines, "l_orderkey", approx=True, alias="estimate").select("estimate", exact.alias("exact"))
    return both.select("exact", (F.abs(F.col("estimate") - F.col("exact")) <= 0.15 * F.col("exact")).alias("within_tolerance"))


@register("top_cuisines", with_ctes(DISHES_CTE) + """
SELECT cuisine_type, count(*) AS count FROM dishes WHERE cuisine_type IS NOT NULL
GROUP BY cuisine_type ORDER BY count DESC, cuisine_type LIMIT 3""")
def top_cuisines(spark, d):
    return G.top_terms(B.documents(spark, d), "cuisine_type", 3)


@register("ingredient_totals", with_ctes(MENTIONS_CTE) + """
SELECT (SELECT count(*) FROM orders) AS total_dishes, count(name) AS total_mentions,
       count(DISTINCT name) AS unique_ingredients FROM mentions""")
def ingredient_totals(spark, d):
    return G.ingredient_totals(B.dishes(spark, d), flat=B.mentions(spark, d, ()))


@register("top_ingredients", with_ctes(MENTIONS_CTE) + """
SELECT name, count(*) AS count FROM mentions WHERE name IS NOT NULL GROUP BY name
ORDER BY count DESC, name LIMIT 20""")
def top_ingredients(spark, d):
    return G.top_ingredients(B.mentions(spark, d, ()), 20)


@register("ingredient_frequency", with_ctes(MENTIONS_CTE) + """
SELECT name, count(*) AS mentions, count(DISTINCT id) AS dishes,
       round(count(DISTINCT id) * 100.0 / (SELECT count(*) FROM orders), 6) AS percent
FROM mentions WHERE name IS NOT NULL GROUP BY name ORDER BY mentions DESC, name LIMIT 30""")
def ingredient_frequency(spark, d):
    return G.ingredient_frequency(B.dishes(spark, d), 30, flat=B.mentions(spark, d, ()))


@register("top_ingredients_with_titles", with_ctes(DISHES_CTE, MENTIONS_CTE, """
top AS (SELECT name, count(*) AS mentions, count(DISTINCT id) AS dishes FROM mentions WHERE name IS NOT NULL
        GROUP BY name ORDER BY mentions DESC, name LIMIT 50),
per_title AS (SELECT m.name, r.title, count(DISTINCT m.id) AS title_count
              FROM mentions m JOIN dishes r ON m.id = r.id WHERE m.name IN (SELECT name FROM top)
              GROUP BY m.name, r.title),
best AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY title_count DESC, title) AS rk FROM per_title)""") + """
SELECT t.name, t.mentions, t.dishes,
       coalesce((SELECT string_agg(b.title, '|' ORDER BY b.rk) FROM best b WHERE b.name = t.name AND b.rk <= 3), '')
         AS titles
FROM top t""")
def top_ingredients_with_titles(spark, d):
    out = G.top_with_samples(B.dishes(spark, d), 50, 3, flat=B.mentions(spark, d, ("title",), by_dish=True))
    return out.select("name", "mentions", "dishes", F.array_join("titles", "|").alias("titles"))


@register("difficulty_profile", with_ctes(DISHES_CTE, MENTIONS_CTE) + """
SELECT r.difficulty, count(*) AS count, round(avg(r.total_time_minutes), 6) AS avg_time,
       sum(coalesce(c.n, 0)) AS ingredient_mentions, round(avg(r.post_score), 6) AS avg_score
FROM dishes r LEFT JOIN (SELECT id, count(name) AS n FROM mentions GROUP BY id) c ON r.id = c.id
WHERE r.difficulty IS NOT NULL GROUP BY r.difficulty""")
def difficulty_profile(spark, d):
    return G.profile_by(B.dishes(spark, d), "difficulty", flat=B.mentions(spark, d, ()))


@register("cuisine_top_hits", with_ctes(DISHES_CTE, _TOP_GROUPS.format(n=20), """
ranked AS (
  SELECT cuisine_type, CAST(row_number() OVER (PARTITION BY cuisine_type ORDER BY post_score DESC NULLS LAST, id)
         AS INTEGER) AS rank, id, post_score, title, difficulty, total_time_minutes
  FROM dishes WHERE cuisine_type IN (SELECT cuisine_type FROM top_groups))""") + """
SELECT k.*, g.group_count FROM ranked k JOIN top_groups g ON k.cuisine_type = g.cuisine_type WHERE k.rank <= 3""")
def cuisine_top_hits(spark, d):
    return G.top_hits(B.documents(spark, d), "cuisine_type", "post_score", 3, 20)


@register("cuisine_difficulty", with_ctes(DISHES_CTE, _TOP_GROUPS.format(n=20), """
counts AS (SELECT cuisine_type, difficulty, count(*) AS count FROM dishes
           WHERE cuisine_type IN (SELECT cuisine_type FROM top_groups) AND difficulty IS NOT NULL
           GROUP BY cuisine_type, difficulty)""") + """
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY cuisine_type ORDER BY count DESC, difficulty) AS INTEGER)
               AS rank FROM counts) WHERE rank <= 10""")
def cuisine_difficulty(spark, d):
    return G.sub_terms(B.documents(spark, d), "cuisine_type", "difficulty")


@register("filtered_mentions", with_ctes(DISHES_CTE, MENTIONS_CTE) + """
SELECT coalesce(sum(coalesce(c.n, 0)), 0) AS ingredient_mentions, count(*) AS hits
FROM dishes r LEFT JOIN (SELECT id, count(name) AS n FROM mentions GROUP BY id) c ON r.id = c.id
WHERE r.difficulty = 'F'""")
def filtered_mentions(spark, d):
    return G.filtered_mentions(B.dishes(spark, d), F.col("difficulty") == "F", flat=B.mentions(spark, d, ()))
