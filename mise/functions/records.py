"""Record-level extraction, coercion and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicon as lx
from .ingredients import amount_name_col, amount_name_to_ingredient, parse_ingredient_line, parse_ingredient_lines_col
from .metadata import (all_keywords_col, classify_by_groups_col, difficulty_col, first_keyword_col, servings_col,
                       times_col)
from .numbers import leading_int_col, normalize_by_synonyms_col, to_integer_col, to_number_col
from .text import ColumnOrName, clean_instructions_col, col, decode_json_array_col, description_col, split_sections_col


# ---------------------------------------------------------------------------------------- B17
def extract_posts(df: DataFrame, comment: str = "comment", title: str = "title", out: str = "dish",
                  ingredient_style: str = "post") -> DataFrame:
    """Free-text post -> record struct (sections, ingredients, steps, metadata).

    The sections struct is materialised in its own projection so the fold over lines runs once.
    """
    tmp = "__sections"
    d = df.withColumn(tmp, split_sections_col(comment))
    sec = F.col(tmp)
    text = F.col(comment)
    if ingredient_style == "separator":
        ingredients = F.transform(amount_name_col(sec["ingredients"], "post"), amount_name_to_ingredient)
    else:
        ingredients = parse_ingredient_lines_col(sec["ingredients"], "post")
    times = times_col(text)
    cuisine = first_keyword_col(text, lx.CUISINES)
    record = F.struct(
        F.col(title).alias("title"),
        description_col(text, sec["general"]).alias("description"),
        ingredients.alias("ingredients"),
        clean_instructions_col(sec["instructions"], "post").alias("instructions"),
        times["prepTime"].alias("prepTime"), times["cookTime"].alias("cookTime"), times["totalTime"].alias("totalTime"),
        servings_col(text).alias("servings"),
        difficulty_col(text).alias("difficulty"),
        cuisine.alias("cuisineType"), cuisine.alias("cuisine"),
        first_keyword_col(text, lx.COURSES).alias("course"),
        F.coalesce(first_keyword_col(text, lx.MEALS), classify_by_groups_col(text)).alias("mealType"),
        all_keywords_col(text, lx.DIETARY).alias("dietaryTags"),
    )
    return d.withColumn(out, record).drop(tmp)


# ---------------------------------------------------------------------------------------- B18
def extract_structured(df: DataFrame, ingredients: str = "ingredients", directions: str = "directions",
                       title: str = "title", out: str = "dish", ingredient_style: str = "line",
                       scope: str = "all") -> DataFrame:
    """Structured row (JSON-array cells of ingredients and directions) -> record struct.

    ``scope='directions'`` reads servings and times from the directions only (B19).
    """
    from .metadata import direction_servings_col, direction_times_col

    ing, dirs, txt = "__ing", "__dirs", "__text"
    d = (df.withColumn(ing, decode_json_array_col(ingredients))
           .withColumn(dirs, decode_json_array_col(directions)))
    d = d.withColumn(txt, F.lower(F.array_join(F.concat(F.col(ing), F.col(dirs)), " ")))
    text = F.col(txt)
    if ingredient_style == "separator":
        parsed = F.transform(amount_name_col(ing, "structured"), amount_name_to_ingredient)
    else:
        parsed = F.transform(F.col(ing), lambda l: parse_ingredient_line(l, "line"))
    if scope == "directions":
        times = direction_times_col(dirs)
        servings = direction_servings_col(dirs)
    else:
        times = times_col(text, lx.PREP_PATTERNS_STRUCTURED, lx.COOK_PATTERNS_STRUCTURED,
                          lx.TOTAL_PATTERNS_STRUCTURED, infer=False)
        servings = servings_col(text, lx.SERVINGS_PATTERNS_STRUCTURED, infer=False)
    cuisine = first_keyword_col(text, lx.CUISINES_STRUCTURED)
    record = F.struct(
        F.col(title).alias("title"),
        F.lit(None).cast("string").alias("description"),
        parsed.alias("ingredients"),
        clean_instructions_col(dirs, "structured").alias("instructions"),
        times["prepTime"].alias("prepTime"), times["cookTime"].alias("cookTime"), times["totalTime"].alias("totalTime"),
        servings.alias("servings"),
        difficulty_col(text, lx.DIFFICULTY_PATTERNS_STRUCTURED, lx.EASY_HINTS_STRUCTURED,
                       lx.HARD_HINTS_STRUCTURED, overrides=None).alias("difficulty"),
        cuisine.alias("cuisineType"), cuisine.alias("cuisine"),
        first_keyword_col(text, lx.COURSES_STRUCTURED).alias("course"),
        first_keyword_col(text, lx.MEALS_STRUCTURED).alias("mealType"),
        all_keywords_col(text, lx.DIETARY_STRUCTURED).alias("dietaryTags"),
    )
    return d.withColumn(out, record).drop(ing, dirs, txt)


# ---------------------------------------------------------------------------------------- B24
_NUMBER_TYPE = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"


def _vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def _field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def _str_or(v: Column, default) -> Column:
    """String value; JSON null or missing -> NULL; another type -> ``default``."""
    t = _vtype(v)
    return (F.when(v.isNull() | (t == "NULL"), F.lit(None).cast("string"))
            .when(t == "STRING", F.try_variant_get(v, "$", "string"))
            .otherwise(F.lit(default).cast("string")))


def _num_or_str(v: Column) -> Column:
    t = _vtype(v)
    return F.when((t == "STRING") | t.rlike(_NUMBER_TYPE), F.try_variant_get(v, "$", "string"))


def _parsed(json: ColumnOrName, parsed: bool) -> Column:
    return col(json) if parsed else F.try_parse_json(col(json))


def coerce_records_col(json_text: ColumnOrName, parsed: bool = False) -> Column:
    """Tolerant parse of a JSON record into the canonical struct.

    A field of the wrong type takes its default (title 'Untitled Recipe', ingredient name
    'Unknown ingredient', others NULL; arrays that are not arrays of the right element kind
    become empty); a missing field stays NULL; unknown keys are ignored.  ``parsed``: the column is the
    variant that ``try_parse_json`` makes of the text, so that a text is parsed once for all its fields.
    """
    v = _parsed(json_text, parsed)
    ings = _field(v, "ingredients")
    ing_arr = F.try_variant_get(ings, "$", "array<variant>")
    ing_ok = _vtype(ings).startswith("ARRAY") & F.forall(ing_arr, lambda e: _vtype(e).startswith("OBJECT"))
    ingredients = (F.when(ings.isNull() | (_vtype(ings) == "NULL"), F.lit(None))
                   .when(ing_ok, F.transform(ing_arr, lambda e: F.struct(
                       _str_or(_field(e, "name"), "Unknown ingredient").alias("name"),
                       _num_or_str(_field(e, "quantity")).alias("quantity"),
                       _str_or(_field(e, "unit"), None).alias("unit"),
                       _str_or(_field(e, "notes"), None).alias("notes"))))
                   .otherwise(F.array().cast("array<struct<name:string,quantity:string,unit:string,notes:string>>")))

    def str_array(name):
        a = _field(v, name)
        arr = F.try_variant_get(a, "$", "array<variant>")
        ok = _vtype(a).startswith("ARRAY") & F.forall(arr, lambda e: (_vtype(e) == "STRING") | (_vtype(e) == "NULL"))
        return (F.when(a.isNull() | (_vtype(a) == "NULL"), F.lit(None))
                .when(ok, F.transform(arr, lambda e: F.try_variant_get(e, "$", "string")))
                .otherwise(F.array().cast("array<string>")))

    cuisine = _str_or(_field(v, "cuisineType"), None)
    return F.struct(
        _str_or(_field(v, "title"), "Untitled Recipe").alias("title"),
        _str_or(_field(v, "description"), None).alias("description"),
        ingredients.alias("ingredients"),
        str_array("instructions").alias("instructions"),
        _num_or_str(_field(v, "prepTime")).alias("prepTime"),
        _num_or_str(_field(v, "cookTime")).alias("cookTime"),
        _num_or_str(_field(v, "totalTime")).alias("totalTime"),
        _num_or_str(_field(v, "servings")).alias("servings"),
        _str_or(_field(v, "difficulty"), None).alias("difficulty"),
        cuisine.alias("cuisineType"),
        _str_or(_field(v, "cuisine"), None).alias("cuisine"),
        _str_or(_field(v, "course"), None).alias("course"),
        _str_or(_field(v, "mealType"), None).alias("mealType"),
        str_array("dietaryTags").alias("dietaryTags"),
    )


def coerce_records(df: DataFrame, json_col: str, out: str = "recipeData") -> DataFrame:
    return df.withColumn(out, coerce_records_col(json_col))


# ---------------------------------------------------------------------------------------- B25
def validation_errors_col(json_text: ColumnOrName, parsed: bool = False) -> Column:
    """Names of the strict-schema rules a JSON record breaks (empty array when valid); ``parsed`` as in
    :func:`coerce_records_col`."""
    v = _parsed(json_text, parsed)

    # Every check is NULL-safe: ``forall`` returns NULL when a predicate is NULL (a missing
    # field), and a NULL must count as a violation, not as a pass.
    def is_str(x):
        return F.coalesce(_vtype(x) == "STRING", F.lit(False))

    def is_num(x):
        return F.coalesce(_vtype(x).rlike(_NUMBER_TYPE), F.lit(False))

    def opt_str(x):  # optional: may be absent, but when present must be a string
        return x.isNull() | is_str(x)

    ings = _field(v, "ingredients")
    ing_arr = F.try_variant_get(ings, "$", "array<variant>")
    steps = _field(v, "instructions")
    step_arr = F.try_variant_get(steps, "$", "array<variant>")
    rules = [
        ("json", v.isNotNull()),
        ("title", is_str(_field(v, "title"))),
        ("description", opt_str(_field(v, "description"))),
        ("ingredients.type", _vtype(ings).startswith("ARRAY")),
        ("ingredients.min", F.coalesce(F.size(ing_arr) >= 1, F.lit(False))),
        ("ingredients.item", F.coalesce(F.forall(ing_arr, lambda e: is_str(_field(e, "item"))), F.lit(True))),
        ("ingredients.amount", F.coalesce(F.forall(ing_arr, lambda e: is_str(_field(e, "amount"))), F.lit(True))),
        ("ingredients.notes", F.coalesce(F.forall(ing_arr, lambda e: opt_str(_field(e, "notes"))), F.lit(True))),
        ("instructions.type", _vtype(steps).startswith("ARRAY")),
        ("instructions.min", F.coalesce(F.size(step_arr) >= 1, F.lit(False))),
        ("instructions.step", F.coalesce(F.forall(step_arr, lambda e: is_num(_field(e, "step"))), F.lit(True))),
        ("instructions.title", F.coalesce(F.forall(step_arr, lambda e: is_str(_field(e, "title"))), F.lit(True))),
        ("instructions.description", F.coalesce(F.forall(step_arr, lambda e: is_str(_field(e, "description"))),
                                                F.lit(True))),
        ("prepTime", opt_str(_field(v, "prepTime"))),
        ("chillTime", opt_str(_field(v, "chillTime"))),
        ("panSize", opt_str(_field(v, "panSize"))),
    ]
    failed = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules])
    return F.filter(failed, lambda x: x.isNotNull())


def validate_records(df: DataFrame, json_col: str) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, violations); violations carry an ``errors`` array of rule names."""
    checked = df.withColumn("errors", validation_errors_col(json_col))
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


# ---------------------------------------------------------------------------------- B26 / B27
def to_dish_rows(stage: DataFrame, record: str = "recipeData", metadata: str = "metadata",
                   hours: bool = False, fractions: bool = False) -> DataFrame:
    """Staged records -> dish rows with a nested, positioned ingredient list.

    Keeps ``dataset`` / ``entryNumber`` when present so outcomes can be traced to entries.
    """
    r, m = F.col(record), F.col(metadata)
    prep = to_integer_col(r["prepTime"], hours=hours)
    cook = to_integer_col(r["cookTime"], hours=hours)
    comments = F.nullif(leading_int_col(m["num_comments"]), F.lit(0))
    servings = to_integer_col(r["servings"]).try_cast("decimal(10,2)")
    # A number that its column can't hold makes the row an error, not the job.
    numbers = [("prep_time_minutes", to_number_col(r["prepTime"], hours=hours), prep),
               ("cook_time_minutes", to_number_col(r["cookTime"], hours=hours), cook),
               ("servings", to_number_col(r["servings"]), servings)]
    error = F.coalesce(*[F.when(n.isNotNull() & v.isNull(), F.lit(f"{c} out of range")) for c, n, v in numbers],
                       F.lit(None).cast("string"))
    tags = F.array_compact(r["dietaryTags"])
    ingredients = F.transform(r["ingredients"], lambda e, i: F.struct(
        F.coalesce(F.nullif(e["name"], F.lit("")), F.lit("Unknown ingredient")).alias("name"),
        F.nullif(e["unit"], F.lit("")).alias("unit"),
        to_number_col(e["quantity"], fractions=fractions).alias("amount"),
        F.nullif(e["notes"], F.lit("")).alias("notes"),
        (i + 1).alias("order_index")))
    keep = [c for c in ("dataset", "entryNumber") if c in stage.columns]
    return stage.select(
        *keep,
        F.coalesce(F.nullif(r["title"], F.lit("")), F.nullif(m["title"], F.lit("")),
                   F.lit("Untitled Recipe")).alias("title"),
        F.nullif(r["description"], F.lit("")).alias("description"),
        F.coalesce(F.array_compact(r["instructions"]), F.array().cast("array<string>")).alias("instructions"),
        prep.alias("prep_time_minutes"), cook.alias("cook_time_minutes"),
        F.when((F.coalesce(prep, F.lit(0)) != 0) & (F.coalesce(cook, F.lit(0)) != 0),
               (prep.cast("bigint") + cook).try_cast("int")).alias("total_time_minutes"),
        servings.alias("servings"),
        normalize_by_synonyms_col(r["difficulty"], lx.DIFFICULTY_SYNONYMS).alias("difficulty"),
        F.nullif(F.coalesce(r["cuisineType"], r["cuisine"]), F.lit("")).alias("cuisine_type"),
        normalize_by_synonyms_col(r["mealType"], lx.MEAL_SYNONYMS).alias("meal_type"),
        F.when(F.size(tags) > 0, tags).alias("dietary_tags"),
        m["link"].alias("source_url"),
        m["user"].alias("post_author"),
        comments.alias("post_score"), comments.alias("post_comments"),
        F.coalesce(ingredients, F.array().cast(
            "array<struct<name:string,unit:string,amount:double,notes:string,order_index:int>>")).alias("ingredients"),
        error.alias("error"),
    )


# ---------------------------------------------------------------------------------------- B31
def extraction_counts(df: DataFrame, by: str = "dataset", record: str = "recipeData") -> DataFrame:
    """Ingredients and steps found, summed and averaged per ``by``; entries with none counted."""
    n_ing = F.coalesce(F.size(F.col(record)["ingredients"]), F.lit(0))
    n_ins = F.coalesce(F.size(F.col(record)["instructions"]), F.lit(0))
    d = df.select(F.col(by), n_ing.alias("n_ing"), n_ins.alias("n_ins"))
    return d.groupBy(by).agg(
        F.count(F.lit(1)).alias("entries"),
        F.sum("n_ing").alias("ingredients_found"), F.sum("n_ins").alias("steps_found"),
        F.round(F.avg("n_ing"), 6).alias("avg_ingredients"), F.round(F.avg("n_ins"), 6).alias("avg_steps"),
        F.count_if(F.col("n_ing") == 0).alias("without_ingredients"),
        F.count_if(F.col("n_ins") == 0).alias("without_steps"),
    )
