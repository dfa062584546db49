"""Schemas of the data model (raw CSV rows, staged records, normalised tables, search documents)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

POST_CSV = T.StructType([T.StructField(n, S) for n in ["date", "num_comments", "title", "user", "comment", "n_char"]])
STRUCTURED_CSV = T.StructType([T.StructField(n, S) for n in
                               ["title", "ingredients", "directions", "link", "source", "NER", "site"]])

INGREDIENT = T.StructType([T.StructField(n, S) for n in ["name", "quantity", "unit", "notes"]])

RECORD = T.StructType([
    T.StructField("title", S), T.StructField("description", S),
    T.StructField("ingredients", T.ArrayType(INGREDIENT)),
    T.StructField("instructions", T.ArrayType(S)),
    T.StructField("prepTime", S), T.StructField("cookTime", S), T.StructField("totalTime", S),
    T.StructField("servings", S), T.StructField("difficulty", S),
    T.StructField("cuisineType", S), T.StructField("cuisine", S), T.StructField("course", S),
    T.StructField("mealType", S), T.StructField("dietaryTags", T.ArrayType(S)),
])

METADATA = T.StructType([T.StructField(n, S) for n in
                         ["title", "user", "date", "num_comments", "n_char", "link", "source", "site", "ner"]])

STAGED = T.StructType([
    T.StructField("dataset", S),
    T.StructField("entryNumber", T.LongType()),
    T.StructField("metadata", METADATA),
    T.StructField("recipeData", RECORD),
])

TS = T.TimestampType()
INGREDIENTS_TABLE = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", S), T.StructField("category", S),
    T.StructField("description", S), T.StructField("created_at", TS), T.StructField("updated_at", TS),
])
MEASUREMENTS_TABLE = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", S), T.StructField("abbreviation", S),
    T.StructField("unit_type", S), T.StructField("created_at", TS), T.StructField("updated_at", TS),
])
DISHES_TABLE = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("title", S), T.StructField("description", S),
    T.StructField("instructions", T.ArrayType(S)),
    T.StructField("prep_time_minutes", T.IntegerType()), T.StructField("cook_time_minutes", T.IntegerType()),
    T.StructField("total_time_minutes", T.IntegerType()), T.StructField("servings", T.DecimalType(10, 2)),
    T.StructField("difficulty", S), T.StructField("cuisine_type", S), T.StructField("meal_type", S),
    T.StructField("dietary_tags", T.ArrayType(S)), T.StructField("source_url", S),
    T.StructField("post_id", S), T.StructField("post_author", S),
    T.StructField("post_score", T.IntegerType()), T.StructField("post_comments", T.IntegerType()),
    T.StructField("created_at", TS), T.StructField("updated_at", TS),
])
DISH_INGREDIENTS_TABLE = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("dish_id", T.LongType()),
    T.StructField("ingredient_id", T.LongType()), T.StructField("measurement_id", T.LongType()),
    T.StructField("amount", T.DecimalType(10, 3)), T.StructField("notes", S),
    T.StructField("order_index", T.IntegerType()), T.StructField("created_at", TS),
])

DOC_INGREDIENT = T.StructType([T.StructField("name", S), T.StructField("quantity", T.DoubleType()),
                               T.StructField("unit", S), T.StructField("notes", S)])

# Constraints of the normalised tables.
DIFFICULTY_VALUES = ["easy", "medium", "hard"]
MEAL_TYPE_VALUES = ["breakfast", "lunch", "dinner", "snack", "dessert"]
UNIT_TYPES = ["volume", "weight", "count", "length"]
