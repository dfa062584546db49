"""Registered load / merge (L) queries over the star-table binding."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as SCH
from ..functions import records as RC
from ..operators import load as L
from . import bindings as B
from .catalog import MENTIONS_CTE, DISHES_CTE, register, with_ctes
from .queries_search import TDOCS_CTE


def _dim(spark, d, table, pred):
    """Existing dimension with unique names (smallest id per name) from a filtered table."""
    if table == "part":
        src = B.ingredients(spark, d).join(B.table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_brand"),
                                           "id").filter(pred)
    else:
        src = B.measurements(spark, d).join(
            B.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), "s_nationkey"), "id").filter(pred)
    return src.groupBy("name").agg(F.min("id").alias("id")).select(
        "id", "name", F.lit(None).cast("string").alias("category"), F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("updated_at"))


@register("resolve_titles", """
SELECT doc_id AS id, coalesce(nullif(split_part(text, chr(10), 1), ''), 'Untitled Recipe') AS title FROM documents""")
def resolve_titles(spark, d):
    docs = B.text_documents(spark, d)
    return L.resolve_title(docs, "title", F.lit(None).cast("string"), "title").select("id", "title")


@register("dedupe_documents", """
SELECT min(doc_id) AS id FROM documents GROUP BY text""")
def dedupe_documents(spark, d):
    # A SHA-256 of the text stands in for the text as the grouping key, so only (key, id) is
    # shuffled and sorted, never the documents themselves.
    docs = B.text_documents(spark, d).select("id", F.sha2("text", 256).alias("text_key"))
    return L.first_per_key(docs, "text_key", ["id"]).select("id")


@register("insert_absent_titles", with_ctes(TDOCS_CTE) + """
SELECT id, title FROM tdocs WHERE lang <> 'en' AND title NOT IN (SELECT title FROM tdocs WHERE lang = 'en')""")
def insert_absent_titles(spark, d):
    docs = B.text_documents(spark, d)
    fresh, _ = L.insert_absent(docs.filter(F.col("lang") == "en"), docs.filter(F.col("lang") != "en"), "title")
    return fresh.select("id", "title")


@register("existing_titles_report", with_ctes(TDOCS_CTE) + """
SELECT n.id, n.title, e.existing_id FROM tdocs n
JOIN (SELECT title, min(id) AS existing_id FROM tdocs WHERE lang = 'en' GROUP BY title) e ON n.title = e.title
WHERE n.lang <> 'en'""")
def existing_titles_report(spark, d):
    docs = B.text_documents(spark, d)
    _, present = L.insert_absent(docs.filter(F.col("lang") == "en"), docs.filter(F.col("lang") != "en"), "title")
    return present.select("id", "title", "existing_id")


@register("upsert_ingredients", """
WITH ex AS (SELECT min(p_partkey) AS id, p_name AS name FROM part WHERE p_brand = 'Brand#1' GROUP BY p_name),
nw AS (SELECT DISTINCT p.p_name AS name FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
       WHERE p.p_name NOT IN (SELECT name FROM ex))
SELECT id, name FROM ex
UNION ALL SELECT (SELECT max(id) FROM ex) + row_number() OVER (ORDER BY name) AS id, name FROM nw""")
def upsert_ingredients(spark, d):
    dim = _dim(spark, d, "part", F.col("p_brand") == "Brand#1")
    names = B.junction(spark, d).join(B.ingredients(spark, d).select(F.col("id").alias("ingredient_id"), "name"),
                                      "ingredient_id").select("name")
    return L.upsert_dimension(dim, names).select("id", "name")


@register("upsert_measurements", """
WITH ex AS (SELECT min(s_suppkey) AS id, s_name AS name FROM supplier WHERE s_nationkey < 10 GROUP BY s_name),
nw AS (SELECT DISTINCT s.s_name AS name FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
       WHERE s.s_name NOT IN (SELECT name FROM ex))
SELECT id, name FROM ex
UNION ALL SELECT (SELECT max(id) FROM ex) + row_number() OVER (ORDER BY name) AS id, name FROM nw""")
def upsert_measurements(spark, d):
    dim = _dim(spark, d, "supplier", F.col("s_nationkey") < 10)
    units = B.junction(spark, d).join(B.measurements(spark, d).select(F.col("id").alias("measurement_id"), "name"),
                                      "measurement_id").select("name")
    return L.upsert_dimension(dim, units).select("id", "name")


_JUNCTION_SQL = with_ctes(MENTIONS_CTE, """
ing AS (SELECT p_name AS name, min(p_partkey) AS ingredient_id FROM part GROUP BY p_name),
pos AS (SELECT m.*, s.s_name AS unit,
               row_number() OVER (PARTITION BY m.id ORDER BY m.order_index, m.l_partkey, m.l_suppkey, m.l_quantity,
                                  m.l_extendedprice) AS position
        FROM mentions m JOIN supplier s ON m.l_suppkey = s.s_suppkey)""") + """
SELECT p.id AS dish_id, i.ingredient_id, s.s_suppkey AS measurement_id, CAST(p.l_quantity AS DECIMAL(10,3)) AS amount,
       CAST(p.position AS INTEGER) AS order_index
FROM pos p JOIN ing i ON p.name = i.name LEFT JOIN supplier s ON p.unit = s.s_name"""


@register("build_junction_rows", _JUNCTION_SQL)
def build_junction_rows(spark, d):
    docs = B.documents(spark, d)
    dishes = docs.select("id", F.transform("ingredients", lambda e: F.struct(
        e["name"].alias("name"), e["unit"].alias("unit"), e["quantity"].alias("amount"), e["notes"].alias("notes"),
        F.lit(0).alias("order_index"))).alias("ingredients"))
    ing = B.ingredients(spark, d).groupBy("name").agg(F.min("id").alias("id"))
    out = L.build_junction(dishes, ing, B.measurements(spark, d))
    return out.select("dish_id", "ingredient_id", "measurement_id", "amount", "order_index")


@register("insert_ignore_lines", """
WITH ex AS (SELECT l_orderkey AS dish_id, l_partkey AS ingredient_id, l_linenumber AS order_index
            FROM lineitem WHERE l_returnflag = 'R'),
nw AS (SELECT DISTINCT l_orderkey AS dish_id, l_partkey AS ingredient_id, l_linenumber AS order_index FROM lineitem)
SELECT * FROM ex UNION ALL
SELECT * FROM nw WHERE (dish_id, ingredient_id, order_index) NOT IN (SELECT (dish_id, ingredient_id, order_index) FROM ex)""")
def insert_ignore_lines(spark, d):
    j = B.junction(spark, d).select("dish_id", "ingredient_id", "order_index", "notes")
    out = L.insert_ignore(j.filter(F.col("notes") == "R"), j, ["dish_id", "ingredient_id", "order_index"])
    return out.select("dish_id", "ingredient_id", "order_index")


@register("update_dishes", with_ctes(DISHES_CTE) + """
SELECT id, CASE WHEN difficulty = 'F' THEN 'finished' ELSE difficulty END AS difficulty, cuisine_type FROM dishes""")
def update_dishes(spark, d):
    r = B.dishes(spark, d)
    upd = r.filter(F.col("difficulty") == "F").select("id", F.lit("finished").alias("difficulty"))
    return L.update_columns(r, upd).select("id", "difficulty", "cuisine_type")


@register("replace_lines", """
WITH nw AS (SELECT l_orderkey AS dish_id, l_partkey AS ingredient_id, l_linenumber AS order_index
            FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O')
SELECT l_orderkey AS dish_id, l_partkey AS ingredient_id, l_linenumber AS order_index FROM lineitem
WHERE l_orderkey NOT IN (SELECT dish_id FROM nw)
UNION ALL SELECT * FROM nw""")
def replace_lines(spark, d):
    li = B.table(spark, d, "lineitem")
    j = B.junction(spark, d).select("dish_id", "ingredient_id", "order_index")
    new = li.filter((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")).select(
        F.col("l_orderkey").alias("dish_id"), F.col("l_partkey").alias("ingredient_id"),
        F.col("l_linenumber").alias("order_index"))
    return L.replace_children(j, new)


@register("constraint_audit", with_ctes(DISHES_CTE) + """
SELECT 'difficulty_check' AS rule, CAST(id AS VARCHAR) AS key, difficulty AS value FROM dishes
  WHERE difficulty IS NOT NULL AND difficulty NOT IN ('F', 'O')
UNION ALL SELECT 'title_length', CAST(id AS VARCHAR), title FROM dishes WHERE length(title) > 9
UNION ALL SELECT 'title_not_null', CAST(id AS VARCHAR), title FROM dishes WHERE title IS NULL
UNION ALL SELECT 'name_unique', CAST(p_partkey AS VARCHAR), p_name FROM part
  WHERE p_name IN (SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1)
UNION ALL SELECT 'ingredient_fk', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR) FROM lineitem
  WHERE l_partkey NOT IN (SELECT p_partkey FROM part)""")
def constraint_audit(spark, d):
    r = B.dishes(spark, d)
    a = L.check_constraints(r, [L.Rule("difficulty_check", "in_list", "difficulty", ["F", "O"]),
                                L.Rule("title_length", "max_length", "title", 9),
                                L.Rule("title_not_null", "not_null", "title")])
    b = L.check_constraints(B.ingredients(spark, d), [L.Rule("name_unique", "unique", "name")])
    j = B.junction(spark, d).withColumnRenamed("dish_id", "id")
    c = L.check_constraints(j, [L.Rule("ingredient_fk", "fk", "ingredient_id", (B.ingredients(spark, d), "id"))])
    return a.unionByName(b).unionByName(c)


@register("delete_cascade", """
SELECT l_orderkey AS dish_id, l_partkey AS ingredient_id,
       CASE WHEN l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 0) THEN NULL ELSE l_suppkey END
         AS measurement_id, l_linenumber AS order_index
FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
  AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')""")
def delete_cascade(spark, d):
    r, j = B.dishes(spark, d), B.junction(spark, d)
    _, j = L.delete_dishes(r, j, r.filter(F.col("difficulty") == "P").select("id"))
    ing = B.ingredients(spark, d)
    _, j = L.delete_ingredients(ing, j, ing.filter(F.col("category") == "PROMO").select("id"))
    m = B.measurements(spark, d)
    _, j = L.delete_measurements(m, j, m.filter(F.col("unit_type") == "0").select("id"))
    return j.select("dish_id", "ingredient_id", "measurement_id", "order_index")


def _stage_rows(spark, d):
    """Dish rows shaped like ``to_dish_rows`` output, from the star documents; titles repeat."""
    docs = B.documents(spark, d)
    return docs.select(
        F.lit("orders").alias("dataset"), F.col("id").alias("entryNumber"),
        F.concat_ws(" ", "cuisine_type", "difficulty").alias("title"),
        # The letters as the levels that the table allows.
        F.when(F.col("difficulty") == "F", "easy").when(F.col("difficulty") == "O", "medium").otherwise("hard").alias("difficulty"),
        "cuisine_type", "total_time_minutes",
        F.transform("ingredients", lambda e, i: F.struct(
            e["name"].alias("name"), e["unit"].alias("unit"), e["quantity"].alias("amount"), e["notes"].alias("notes"),
            (i + 1).alias("order_index"))).alias("ingredients"))


def _empty_tables(spark):
    return L.Tables(spark.createDataFrame([], SCH.DISHES_TABLE), spark.createDataFrame([], SCH.DISH_INGREDIENTS_TABLE),
                    spark.createDataFrame([], SCH.INGREDIENTS_TABLE), spark.createDataFrame([], SCH.MEASUREMENTS_TABLE))


_LOAD_CTE = with_ctes(DISHES_CTE, """
st AS (SELECT id AS entry, cuisine_type || ' ' || difficulty AS title FROM dishes),
firsts AS (SELECT title, min(entry) AS entry FROM st GROUP BY title),
ids AS (SELECT title, entry, row_number() OVER (ORDER BY entry) AS dish_id FROM firsts)""")


@register("load_outcomes", _LOAD_CTE + """
SELECT s.entry AS entryNumber, s.title, i.dish_id,
       CASE WHEN s.entry = i.entry THEN 'inserted' ELSE 'existing' END AS status
FROM st s JOIN ids i ON s.title = i.title""")
def load_outcomes(spark, d):
    _, outcome = L.load_stage(_stage_rows(spark, d), _empty_tables(spark))
    return outcome.select("entryNumber", "title", "dish_id", "status")


_BAD_CTE = with_ctes("""
st AS (SELECT o_orderkey AS entry, o_orderkey % 8 AS kind,
              'dish ' || CAST(o_orderkey // 16 AS VARCHAR) || ' ' || CAST(o_orderkey % 8 AS VARCHAR) AS plain FROM orders),
staged AS (SELECT entry, kind, CASE WHEN kind = 2 THEN plain || repeat('x', 600) ELSE plain END AS title,
                  CASE kind WHEN 0 THEN 'prep_time_minutes out of range' WHEN 1 THEN 'servings out of range' WHEN 2 THEN 'title too long'
                            WHEN 3 THEN 'amount out of range' WHEN 4 THEN 'ingredient name too long' END AS error FROM st),
firsts AS (SELECT title, min(entry) AS entry FROM staged WHERE error IS NULL GROUP BY title),
ids AS (SELECT title, entry, row_number() OVER (ORDER BY entry) AS dish_id FROM firsts)""")


@register("load_failures", _BAD_CTE + """
SELECT r.entry AS entryNumber, r.title, i.dish_id, r.error,
       CASE WHEN r.error IS NOT NULL THEN 'failed' WHEN r.entry = i.entry THEN 'inserted' ELSE 'existing' END AS status
FROM staged r LEFT JOIN ids i ON r.title = i.title""")
def load_failures(spark, d):
    """Staged records of the orders, five in eight with a value that a table can't hold."""
    key, kind = F.col("o_orderkey"), F.col("o_orderkey") % 8
    text = lambda x: F.lit(x).cast("string")
    plain = F.concat(F.lit("dish "), F.floor(key / 16).cast("string"), F.lit(" "), kind.cast("string"))
    fields = {"title": F.when(kind == 2, F.concat(plain, F.repeat(F.lit("x"), 600))).otherwise(plain),
              "prepTime": F.when(kind == 0, text("99999999999 min")).otherwise(text("10 min")),
              "cookTime": text("20 min"), "servings": F.when(kind == 1, text("123456789")).otherwise(text("4")),
              "difficulty": text("Easy"), "ingredients": F.array(F.struct(
                  F.when(kind == 4, F.repeat(F.lit("n"), 201)).otherwise(text("salt")).alias("name"),
                  F.when(kind == 3, text("12345678")).otherwise(text("2")).alias("quantity"),
                  text("cup").alias("unit"), text(None).alias("notes")))}
    record = F.struct(*[fields[f.name].alias(f.name) if f.name in fields else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in SCH.RECORD.fields])
    meta = F.struct(*[F.lit(None).cast("string").alias(f.name) for f in SCH.METADATA.fields])
    stage = B.table(spark, d, "orders").select(F.lit("orders").alias("dataset"), key.alias("entryNumber"),
                                               record.alias("recipeData"), meta.alias("metadata"))
    _, outcome = L.load_stage(RC.to_dish_rows(stage), _empty_tables(spark))
    return outcome.select("entryNumber", "title", "dish_id", "status", "error")


@register("load_tables_summary", _LOAD_CTE + """
SELECT (SELECT count(*) FROM ids) AS dishes,
       (SELECT count(*) FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
          WHERE l.l_orderkey IN (SELECT entry FROM ids)) AS junction_rows,
       (SELECT count(DISTINCT p.p_name) FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
          WHERE l.l_orderkey IN (SELECT entry FROM ids)) AS ingredients,
       (SELECT count(DISTINCT s.s_name) FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
          JOIN supplier s ON l.l_suppkey = s.s_suppkey WHERE l.l_orderkey IN (SELECT entry FROM ids)) AS measurements""")
def load_tables_summary(spark, d):
    t, _ = L.load_stage(_stage_rows(spark, d), _empty_tables(spark))
    one = lambda df: df.select(F.count(F.lit(1))).scalar()
    return spark.range(1).select(one(t.dishes).alias("dishes"), one(t.dish_ingredients).alias("junction_rows"),
                                 one(t.ingredients).alias("ingredients"), one(t.measurements).alias("measurements"))


@register("quality_report", """
SELECT count(*) AS dishes, count(*) FILTER (WHERE o_orderkey IS NULL) AS null_titles,
       count(*) FILTER (WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS without_ingredients,
       (SELECT count(*) FROM lineitem) AS junction_rows FROM orders""")
def quality_report(spark, d):
    return L.quality_report(B.dishes(spark, d), B.junction(spark, d))
