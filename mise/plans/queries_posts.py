"""Extraction (B6, B9-B13, B16, B17, B19, B26, B27) over posts written from the star tables.

Each order becomes a post: sentences on servings, times and difficulty in several wordings (some only hint at
them, some say nothing), and a line per order line in three layouts.  The SQL side works the expected values out
from the source columns and never parses a text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import metadata as MD
from ..functions import records as RC
from ..session import spread
from ..sources import staging as ST
from . import bindings as B
from .catalog import register, with_ctes

#: By remainder of the key, what a post says and what is to be found.  {n}: key % 12 + 1, {m}: two more, {p}, {c}: minutes.
#: (Of "minutes" the patterns keep "min", but where a word must follow.)
SERVINGS = [("It serves {n}.", "{n}"), ("Feeds {n} people.", "{n}"), ("It yields {n}-{m} of them.", "{n}-{m}"),
            ("Put it into a 9x13 pan.", "12"), ("Nobody counted.", None)]
TIMES = [("It needs prep time: {p} minutes and cook time: {c} minutes, total time: {t} minutes.", "{p} min", "{c} min", "{t} min"),
         ("Chop it all, then bake for {c} min.", "20-30", "{c} min", None), ("Whisk it well. Cook for {c}-{t} minutes!", "30-45", "{c}-{t} min", None),
         ("No watch was near.", None, None, None), ("Takes {p} minutes to prep, all together: {t} minutes.", "{p} minutes", None, "{t} min")]
DIFFICULTY = [("Difficulty: Hard.", "hard"), ("My skill: beginner.", "beginner"), ("A quick one.", "easy"), ("A complex thing.", "hard"),
              ("Very easy, but temper it.", "medium"), ("So it goes.", None)]
TAGS = [("Vegan and keto.", ["vegan", "keto"]), ("For anyone.", None), ("All paleo.", ["paleo"])]


def _said(key: Column, texts: list[str]) -> Column:
    out = None
    for i, t in enumerate(texts):
        hit = key % len(texts) == i
        out = F.when(hit, F.lit(t)) if out is None else out.when(hit, F.lit(t))
    return out


def _filled(text: Column) -> Column:
    n = F.col("o_orderkey") % 12 + 1
    p, c = F.floor(F.col("o_totalprice") / 5000) + 1, F.floor(F.col("o_totalprice") / 3000) + 2
    for mark, value in (("n", n), ("m", n + 2), ("p", p), ("c", c), ("t", p + c)):
        text = F.replace(text, F.lit("{" + mark + "}"), value.cast("string"))
    return text


def _sentences() -> Column:
    key = F.col("o_orderkey")
    said = [[s for s, _ in SERVINGS], [t[0] for t in TIMES], [d for d, _ in DIFFICULTY], [t for t, _ in TAGS]]
    return _filled(F.concat_ws(" ", *[_said(key, x) for x in said]))


def posts(spark, d):
    """(id, title, comment): one post per order, its lines in order of their text."""
    p = B.table(spark, d, "part").select("p_partkey", "p_name")
    q = F.floor("l_quantity").cast("string")
    q1 = (F.floor("l_quantity") + 1).cast("string")
    line = (F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("- "), q, F.lit(" cups "), "p_name"))
            .when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("* "), q, F.lit("-"), q1, F.lit(" tbsp "), "p_name", F.lit(" (fine)")))
            .otherwise(F.concat(F.lit("2. "), F.lit("1/"), q1, F.lit(" lb "), "p_name")))
    lines = B.table(spark, d, "lineitem").join(p, F.col("l_partkey") == F.col("p_partkey"))
    # At most the lines of one order in a group.
    lines = lines.groupBy(F.col("l_orderkey").alias("k")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    o = B.table(spark, d, "orders").select("o_orderkey", "o_totalprice").join(lines, F.col("o_orderkey") == F.col("k"), "left")
    comment = F.concat(F.lit("A note on this one\n"), _sentences(), F.lit("\nIngredients:\n"), F.array_join(F.coalesce("lines", F.array().cast("array<string>")), "\n"),
                       F.lit("\nDirections:\n1. Stir all of it **together** well.\nok\n- Let it stand until tomorrow."))
    out = o.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title"), comment.alias("comment"))
    return spread(out, "id")


def _cases(key: str, values: list) -> str:
    def one(v) -> str:
        if v is None:
            return "NULL"
        for mark in "nmpct":
            v = v.replace("{" + mark + "}", f"' || CAST({mark} AS VARCHAR) || '")
        return f"'{v}'"

    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {one(v)}" for i, v in enumerate(values)) + " END"


_EXPECTED = [f"""
o AS (SELECT o_orderkey AS id, o_orderkey % 12 + 1 AS n, o_orderkey % 12 + 3 AS m, CAST(floor(o_totalprice / 5000) AS BIGINT) + 1 AS p,
             CAST(floor(o_totalprice / 3000) AS BIGINT) + 2 AS c, CAST(floor(o_totalprice / 5000) AS BIGINT) + CAST(floor(o_totalprice / 3000) AS BIGINT) + 3 AS t FROM orders),
li AS (SELECT l_orderkey AS id, l_linenumber % 3 AS k, CAST(floor(l_quantity) AS BIGINT) AS q, p_name FROM lineitem JOIN part ON l_partkey = p_partkey),
ln AS (SELECT id, CASE k WHEN 0 THEN '- ' || q || ' cups ' || p_name WHEN 1 THEN '* ' || q || '-' || (q + 1) || ' tbsp ' || p_name || ' (fine)'
                         ELSE '2. 1/' || (q + 1) || ' lb ' || p_name END AS raw,
              CASE k WHEN 0 THEN q || '|cups|' WHEN 1 THEN q || '-' || (q + 1) || '|tbsp|' ELSE '1/' || (q + 1) || '|lb|' END || p_name
                || CASE k WHEN 1 THEN '|fine' ELSE '' END AS parsed FROM li),
ag AS (SELECT id, string_agg(parsed, ';' ORDER BY raw) AS parsed, count(*) AS n_lines FROM ln GROUP BY id)"""]


@register("extract_order_posts", with_ctes(*_EXPECTED) + f"""
SELECT id, {_cases('id', [s for _, s in SERVINGS])} AS servings, {_cases('id', [t[1] for t in TIMES])} AS prep_time,
       {_cases('id', [t[2] for t in TIMES])} AS cook_time, {_cases('id', [t[3] for t in TIMES])} AS total_time,
       {_cases('id', [x for _, x in DIFFICULTY])} AS difficulty, {_cases('id', [None if t is None else ','.join(t) for _, t in TAGS])} AS dietary_tags,
       coalesce(ag.parsed, '') AS ingredients, 'Stir all of it together well.|Let it stand until tomorrow.' AS instructions
FROM o LEFT JOIN ag USING (id)""")
def extract_order_posts(spark, d):
    """B17 with every field: servings, times, difficulty and tags said, hinted at or missing; ingredients in post style."""
    r = F.col("dish")
    text = F.transform(r["ingredients"], lambda e: F.concat_ws("|", e["quantity"], e["unit"], e["name"], e["notes"]))
    return RC.extract_posts(posts(spark, d), "comment", "title").select(
        "id", r["servings"].alias("servings"), r["prepTime"].alias("prep_time"), r["cookTime"].alias("cook_time"), r["totalTime"].alias("total_time"),
        r["difficulty"].alias("difficulty"), F.array_join(r["dietaryTags"], ",").alias("dietary_tags"),
        F.array_join(text, ";").alias("ingredients"), F.array_join(r["instructions"], "|").alias("instructions"))


@register("order_post_counts", with_ctes(*_EXPECTED) + """
SELECT o_orderpriority AS dataset, CAST(sum(coalesce(n_lines, 0)) AS BIGINT) AS ingredients_found, round(avg(coalesce(n_lines, 0)), 6) AS avg_ingredients,
       CAST(2 * count(*) AS BIGINT) AS steps_found, count(*) FILTER (n_lines IS NULL) AS without_ingredients
FROM orders JOIN o ON id = o_orderkey LEFT JOIN ag USING (id) GROUP BY o_orderpriority""")
def order_post_counts(spark, d):
    """B31 over posts that do have ingredients, by priority."""
    p = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("dataset"))
    r = RC.extract_posts(posts(spark, d).join(p, "id"), "comment", "title")
    # Counted before they are summed: each figure of an aggregate would parse the lines again.
    r = r.select("dataset", F.size("dish.ingredients").alias("n"), F.size("dish.instructions").alias("steps"))
    return r.groupBy("dataset").agg(F.sum("n").alias("ingredients_found"), F.round(F.avg("n"), 6).alias("avg_ingredients"),
                                    F.sum("steps").alias("steps_found"), F.count_if(F.col("n") == 0).alias("without_ingredients"))


@register("order_post_metadata_plain", with_ctes(*_EXPECTED) + f"""
SELECT id, {_cases('id', ['{n}', '{n}', '{n}-{m}', None, None])} AS servings, {_cases('id', ['{p} min', None, None, None, '{p} minutes'])} AS prep_time FROM o""")
def order_post_metadata_plain(spark, d):
    """B9 and B11 without inference: what is only hinted at stays empty."""
    p = posts(spark, d)
    return p.select("id", MD.servings_col("comment", infer=False).alias("servings"),
                    MD.times_col("comment", infer=False)["prepTime"].alias("prep_time"))


DIRECTIONS = [("Makes about {n} of them.", "{n}"), ("Serves {n}-{m} well.", "{n}-{m}"), ("Eat it.", None)]
COOKING = [("Cook time: {c} minutes.", "{c} min"), ("Bake {c} min.", "{c} min"), ("Wait.", None)]


@register("order_directions", with_ctes(*_EXPECTED) + f"""
SELECT id, {_cases('id', [s for _, s in DIRECTIONS])} AS servings, {_cases('id', [s for _, s in COOKING])} AS cook_time,
       {_cases('id', ['{t} min', None])} AS total_time FROM o""")
def order_directions(spark, d):
    """Servings of the first direction that states them, times of the directions only."""
    key = F.col("o_orderkey")
    o = B.table(spark, d, "orders")
    said = [F.lit("Stir it all together."), _said(key, [s for s, _ in DIRECTIONS]), _said(key, [s for s, _ in COOKING]),
            _said(key, ["Total time: {t} minutes.", "That is all."]), F.lit("Makes 99.")]
    first = o.select(key.alias("id"), F.array(*[_filled(s) for s in said[:4]]).alias("directions"))
    times = MD.direction_times_col("directions")
    return first.select("id", MD.direction_servings_col("directions").alias("servings"), times["cookTime"].alias("cook_time"),
                        times["totalTime"].alias("total_time"))


@register("order_post_rows", with_ctes(*_EXPECTED) + f"""
SELECT 'order ' || id AS title, CAST(regexp_extract({_cases('id', [s for _, s in SERVINGS])}, '[0-9]+') AS DECIMAL(10, 2)) AS servings,
       CAST(regexp_extract({_cases('id', [t[1] for t in TIMES])}, '[0-9]+') AS INT) AS prep_time_minutes,
       CAST(regexp_extract({_cases('id', [t[2] for t in TIMES])}, '[0-9]+') AS INT) AS cook_time_minutes,
       CAST(regexp_extract({_cases('id', [t[1] for t in TIMES])}, '[0-9]+') AS INT) + CAST(regexp_extract({_cases('id', [t[2] for t in TIMES])}, '[0-9]+') AS INT) AS total_time_minutes,
       {_cases('id', ['hard', 'easy', 'easy', 'hard', 'medium', None])} AS difficulty, {_cases('id', ['vegan,keto', None, 'paleo'])} AS dietary_tags,
       2 AS steps, CAST(coalesce(n_lines, 0) AS INT) AS lines FROM o LEFT JOIN ag USING (id)""")
def order_post_rows(spark, d):
    """Staged posts, with null entries among their steps and tags, as rows."""
    r = RC.extract_posts(posts(spark, d), "comment", "title").withColumns({"dataset": F.lit("orders"), "entry_number": F.col("id")})
    none = F.array(F.lit(None).cast("string"))
    holed = F.col("dish").withField("instructions", F.concat(none, F.col("dish.instructions"), none)).withField(
        "dietaryTags", F.concat(F.coalesce(F.col("dish.dietaryTags"), F.array().cast("array<string>")), none))
    stage = ST.to_stage(r.withColumn("dish", holed), {"title": "title"})
    rows = RC.to_dish_rows(stage)
    return rows.select("title", "servings", "prep_time_minutes", "cook_time_minutes", "total_time_minutes", "difficulty",
                       F.array_join("dietary_tags", ",").alias("dietary_tags"), F.size("instructions").alias("steps"), F.size("ingredients").alias("lines"))
