"""Worked values for the text-to-structure functions (FIXTURES sections 4, 5, 6, 7)."""

from pyspark.sql import functions as F

from mise.functions import lexicon as lx
from mise.functions import numbers as NB
from mise.functions import records as RC
from mise.functions import text as TX
from mise.functions.ingredients import amount_name, parse_ingredient_line


def _parse(spark, lines, style="line"):
    df = spark.createDataFrame([(l,) for l in lines], "line string")
    return [tuple(r) for r in df.select(parse_ingredient_line(F.col("line"), style).alias("p")).select("p.*").collect()]


def test_ingredient_lines(spark):
    got = _parse(spark, ["1 cup sugar", "1 tsp salt", "1 1/2 cups flour (sifted)", "2-3 tbsp rum", "3 t vanilla",
                         "1 c. sugar", "2 Tbsp. butter", "4 cloves garlic, minced", "salt", "2 co2 cartridges",
                         "3 T oil"])
    assert got == [
        ("sugar", "1", "cup", None), ("salt", "1", "tsp", None), ("flour", "1 1/2", "cups", "sifted"),
        ("rum", "2-3", "tbsp", None), ("vanilla", "3", "t", None), ("sugar", "1", "c", None),
        ("butter", "2", "tbsp", None), ("garlic, minced", "4", "cloves", None), ("salt", None, None, None),
        ("co2 cartridges", "2", None, None), ("oil", "3", "T", None)]


def test_post_style_keeps_ranges(spark):
    got = _parse(spark, ["- 2-3 tbsp rum", "1. 2 cups flour (sifted)", "* 1.5 cups milk"], "post")
    assert got == [("rum", "2-3", "tbsp", None), ("flour", "2", "cups", "sifted"), ("milk", "1.5", "cups", None)]


def test_separator_style(spark):
    df = spark.createDataFrame([("9 Tbsp - rum or marsala wine",), ("1 tsp: vanilla extract",), ("2-3 Tbsp cocoa",)],
                               "line string")
    got = [tuple(r) for r in df.select(amount_name(F.col("line")).alias("a")).select("a.*").collect()]
    assert got == [("9 Tbsp", "rum or marsala wine"), ("1 tsp", "vanilla extract"), ("2", "3 Tbsp cocoa")]


def test_numbers(spark):
    vals = ["2-4", "30-45 minutes", "1-2 cups", "60", "1.5", "3.5", "1 hour", "1/2", "1 1/2", "a pinch", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    out = df.select(NB.to_number_col("v").alias("n"), NB.to_integer_col("v").alias("i"),
                    NB.to_number_col("v", fractions=True).alias("f"), NB.to_integer_col("v", hours=True).alias("h"))
    rows = [tuple(r) for r in out.collect()]
    assert [r[0] for r in rows] == [2, 30, 1, 60, 1.5, 3.5, 1, 1, 1, None, None]
    assert [r[1] for r in rows][4:6] == [2, 4]
    assert [r[2] for r in rows][7:9] == [0.5, 1.5]
    assert rows[6][3] == 60


def test_categories(spark):
    df = spark.createDataFrame([("Super easy",), ("Moderate",), ("beginner",), ("challenging",), ("tough",)], "d string")
    got = [r[0] for r in df.select(NB.normalize_by_synonyms_col("d", lx.DIFFICULTY_SYNONYMS)).collect()]
    assert got == ["easy", "medium", "easy", "hard", None]
    df = spark.createDataFrame([("Dinner or lunch",), ("main",), ("soup",), ("Brunch",)], "m string")
    got = [r[0] for r in df.select(NB.normalize_by_synonyms_col("m", lx.MEAL_SYNONYMS)).collect()]
    assert got == ["lunch", None, None, "breakfast"]


POST = """Title: Easy Layered Cream Dessert (no raw eggs!)
Serves a crowd, and it is quick.

Ingredients:
- 2 cups cream
- 1/2 cup sugar
- 3 tbsp cocoa powder (sifted)

Instructions:
1. Whip the cream with the sugar until stiff peaks form.
2. Fold in the cocoa **gently** and spoon into cups.
Prep time: 30 minutes
3. Chill for at least 6 hours before serving.
"""


def test_extract_post(spark):
    df = spark.createDataFrame([(POST, "t")], "comment string, title string")
    r = RC.extract_posts(df, "comment", "title").select("dish.*").first()
    assert [i.name for i in r.ingredients] == ["cream", "sugar", "cocoa powder"]
    assert [i.quantity for i in r.ingredients] == ["2", "1/2", "3"]
    assert r.ingredients[2].notes == "sifted"
    # "Prep time: 30 minutes" is a section header line and is dropped from the steps
    assert len(r.instructions) == 3 and r.instructions[1] == "Fold in the cocoa gently and spoon into cups."
    assert r.prepTime == "30 min"
    assert r.difficulty == "medium"          # 'easy' then overridden by whip / fold / layered
    assert r.mealType == "dessert"
    assert r.dietaryTags == ["raw"]          # substring match of "raw eggs"
    assert r.description.startswith("Title: Easy Layered")


def test_json_cells_and_lists(spark):
    df = spark.createDataFrame([('["a","b"]',), ("not json",)], "c string")
    assert [r[0] for r in df.select(TX.decode_json_array_col("c")).collect()] == [["a", "b"], ["not json"]]
    df = spark.createDataFrame([("chicken, garlic ;rice|\n onion ,,",)], "c string")
    assert df.select(TX.split_list_col("c")).first()[0] == ["chicken", "garlic", "rice", "onion"]
    df = spark.createDataFrame([(["mix", "bake"],)], "a array<string>")
    assert df.select(TX.render_text_col("a")).first()[0] == "1. mix\n2. bake"


def test_validation_and_coercion(spark):
    good = ('{"title":"T","ingredients":[{"item":"flour","amount":"2-3 cups"}],'
            '"instructions":[{"step":1,"title":"Mix","description":"Mix it"}]}')
    bad_item = ('{"title":"T","ingredients":[{"item":5,"amount":"1"}],'
                '"instructions":[{"step":"one","title":"Mix","description":"Mix it"}]}')
    none = '{"ingredients":[],"instructions":[]}'
    df = spark.createDataFrame([(good,), (bad_item,), (none,)], "j string")
    errs = [r[0] for r in df.select(RC.validation_errors_col("j")).collect()]
    assert errs[0] == []
    assert "ingredients.item" in errs[1] and "instructions.step" in errs[1]
    assert {"title", "ingredients.min", "instructions.min"} <= set(errs[2])
    df = spark.createDataFrame([('{"title":5,"ingredients":[{"name":"a","quantity":2},{"name":"b","quantity":true}]}',),
                                ('{"ingredients":"x","extra":1}',)], "j string")
    rows = df.select(RC.coerce_records_col("j").alias("r")).select("r.title", "r.ingredients").collect()
    assert rows[0][0] == "Untitled Recipe" and [i.quantity for i in rows[0][1]] == ["2", None]
    assert rows[1][0] is None and rows[1][1] == []


def test_direction_scope(spark):
    from mise.functions.metadata import direction_servings_col, direction_times_col
    df = spark.createDataFrame([(["Preheat the oven.", "Bake 20 min. Makes about 24 cookies.", "Serves 4-6"],)],
                               "d array<string>")
    r = df.select(direction_servings_col("d").alias("s"), direction_times_col("d").alias("t")).first()
    assert r.s == "24" and r.t.cookTime == "20 min" and r.t.prepTime is None


def test_dish_rows_mapping(spark):
    from mise import schemas as SCH
    rec = {"title": None, "description": "", "ingredients": [
        {"name": None, "quantity": "1/2", "unit": "cup", "notes": None},
        {"name": "salt", "quantity": "2-4", "unit": None, "notes": "to taste"}],
        "instructions": ["Mix", None], "prepTime": "30", "cookTime": "0", "totalTime": None, "servings": "1.5",
        "difficulty": "Super easy", "cuisineType": None, "cuisine": "italian", "course": None,
        "mealType": "Dinner or lunch", "dietaryTags": [None]}
    meta = {"title": "Meta title", "user": "u1", "num_comments": "0"}
    df = spark.createDataFrame([("posts", 7, meta, rec)], SCH.STAGED)
    r = RC.to_dish_rows(df).first()
    assert r.title == "Meta title" and r.description is None
    assert r.instructions == ["Mix"] and r.dietary_tags is None
    assert (r.prep_time_minutes, r.cook_time_minutes, r.total_time_minutes) == (30, 0, None)
    assert float(r.servings) == 2.0 and r.difficulty == "easy" and r.meal_type == "lunch"
    assert r.cuisine_type == "italian" and r.post_score is None and r.post_author == "u1"
    assert [(i.name, i.amount, i.order_index) for i in r.ingredients] == [("Unknown ingredient", 1.0, 1),
                                                                         ("salt", 2.0, 2)]


def test_numbers_keep_their_digits(spark):
    from mise.functions.ingredients import parse_ingredient_line
    lines = ["12345678901234567890123456789 g x", "0.00000000001 g salt", "1.50 cups a\u0001b", "2. cups milk", "007 eggs"]
    df = spark.createDataFrame([(x,) for x in lines], "line string").select(parse_ingredient_line(F.col("line")).alias("p"))
    got = [(r.p.quantity, r.p.name) for r in df.collect()]
    assert got == [("12345678901234567890123456789", "x"), ("0.00000000001", "salt"), ("1.5", "a\u0001b"), ("2", "milk"), ("7", "eggs")]


def test_sections_of_many_lines(spark):
    """Against a plain loop, on a text whose fold line by line would take half a minute."""
    lines = ["Ingredients:" if i % 500 == 0 and i else "Directions:" if i % 500 == 250 else f"line {i}" for i in range(20_000)]
    want, now = {"general": [], "ingredients": [], "instructions": []}, "general"
    for line in lines:
        if line in ("Ingredients:", "Directions:"):
            now = "ingredients" if line[0] == "I" else "instructions"
        else:
            want[now].append(line)
    rows = [("\n".join(lines),), (None,), ("",)]
    got = spark.createDataFrame(rows, "t string").select(TX.split_sections_col("t").alias("s")).select("s.*").collect()
    assert got[0].asDict() == want
    assert tuple(got[1]) == (None, None, None) and tuple(got[2]) == ([""], [], [])


def test_header_tails(spark):
    """Q19: what stands behind a header's colon is dropped, or kept on request."""
    text = "Hello\nIngredients: 2 eggs\n1 cup milk\n**Step 1:** mix it\nStep 2: bake: for an hour\nMethod:\nserve"
    df = spark.createDataFrame([(1, text), (2, None), (3, "Steps")], "i int, t string")
    plain = {r["i"]: r["sections"] for r in TX.split_sections(df, "t").collect()}
    kept = {r["i"]: r["sections"] for r in TX.split_sections(df, "t", keep_header_tail=True).collect()}
    assert (plain[1]["ingredients"], plain[1]["instructions"]) == (["1 cup milk"], ["serve"])
    assert (kept[1]["ingredients"], kept[1]["instructions"]) == (["2 eggs", "1 cup milk"], ["mix it", "bake: for an hour", "serve"])
    assert kept[1]["general"] == plain[1]["general"] == ["Hello"] and kept[3] == plain[3]
