"""Bindings of the dish model to the driver's generated tables.

The generated tables hold no dishes, so each canonical table is a projection of one of them:

=================  ===================================================================
dishes            orders: id = o_orderkey, cuisine_type = o_orderpriority, difficulty =
                   o_orderstatus, created_at = o_orderdate, times and scores from o_totalprice
dish_ingredients lineitem: dish_id = l_orderkey, ingredient_id = l_partkey, measurement_id =
                   l_suppkey, amount = l_quantity, order_index = l_linenumber
ingredients        part: id = p_partkey, name = p_name, category = p_type
measurements       supplier: id = s_suppkey, name = s_name, unit_type = s_nationkey
text documents     documents: title = first line, description = the rest, facets lang/source
staged entries     events: entry_number = event_id, arrival = ts, JSON cell = props
=================  ===================================================================

The same derivations are written in SQL in :mod:`mise.plans.catalog` for the DuckDB oracle.
Everything here is a projection, so Catalyst prunes unused columns down to the parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import tasks_for
from ..operators.relational import build_documents
from ..session import spread

# Junction columns that make the ingredient order total ((order, line) is not unique in lineitem).
TIE_BREAK = ("ingredient_id", "measurement_id", "amount", "price")


# Tables whose rows carry long texts: parsed row by row, so spread over all cores when small.
TEXT_TABLES = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, TEXT_TABLES[name]) if name in TEXT_TABLES else df


def dishes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    total = F.floor(F.col("o_totalprice") / 2000).cast("int")
    prep = F.floor(F.col("o_totalprice") / 5000).cast("int")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.lit(None).cast("string").alias("description"),
        prep.alias("prep_time_minutes"),
        (total - prep).alias("cook_time_minutes"),
        total.alias("total_time_minutes"),
        ((F.col("o_orderkey") % 12) + 1).cast("decimal(10,2)").alias("servings"),
        F.col("o_orderstatus").alias("difficulty"),
        F.col("o_orderpriority").alias("cuisine_type"),
        F.lower(F.expr("substring(o_orderpriority, 3)")).alias("meal_type"),
        F.concat(F.lit("user"), F.col("o_custkey").cast("string")).alias("post_author"),
        (F.col("o_custkey") % 100).cast("int").alias("post_score"),
        (F.floor(F.col("o_totalprice") / 1000) % 100).cast("int").alias("post_comments"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


def dish_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, dietary_tags): sorted distinct return flags of the order's lines."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_set("l_returnflag")).alias("dietary_tags"))


def dishes_with_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dishes(spark, sf_dir).join(dish_tags(spark, sf_dir), "id", "left")


def junction(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("dish_id"),
        F.col("l_partkey").alias("ingredient_id"),
        F.col("l_suppkey").alias("measurement_id"),
        F.col("l_quantity").cast("decimal(10,3)").alias("amount"),
        F.col("l_returnflag").alias("notes"),
        F.col("l_linenumber").alias("order_index"),
        F.col("l_extendedprice").alias("price"),
    )


def ingredients(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"),
                    F.col("p_brand").alias("description"))


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                    F.lit(None).cast("string").alias("abbreviation"),
                    F.col("s_nationkey").cast("string").alias("unit_type"))


def documents(spark: SparkSession, sf_dir: str, tags: bool = False, parts: Sequence[str] | None = None) -> DataFrame:
    """Search documents built from the star tables (R18); ``parts`` of the nested ingredients if not all will be read."""
    r = dishes_with_tags(spark, sf_dir) if tags else dishes(spark, sf_dir)
    return build_documents(r, junction(spark, sf_dir), ingredients(spark, sf_dir), measurements(spark, sf_dir),
                           TIE_BREAK, parts)


def mentions(spark: SparkSession, sf_dir: str, dish_cols=("cuisine_type",), by_dish: bool = False) -> DataFrame:
    """Flat ingredient mentions (id, dish columns..., name): junction rows with a resolved
    ingredient, joined to their dish.  The form the aggregations use at scale.

    ``by_dish`` deals lines and dishes out by dish in parts of bounded size, for groupings that
    hold dish ids (distinct dishes of a name or title)."""
    j = junction(spark, sf_dir).select(F.col("dish_id").alias("id"), "ingredient_id")
    i = ingredients(spark, sf_dir).select(F.col("id").alias("ingredient_id"), "name")
    m = j.join(i, "ingredient_id")
    if dish_cols:
        r = dishes(spark, sf_dir).select("id", *dish_cols)
        if by_dish:
            n = tasks_for(j)
            m, r = m.repartition(n, "id"), r.repartition(n, "id")
        m = m.join(r, "id")
    return m.select("id", *dish_cols, "name")


def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as searchable records: title = first line, description = remaining text."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.when(F.instr("text", "\n") > 0, F.expr("substring(text, instr(text, '\\n') + 1)")).alias("description"),
        F.col("text"), F.col("lang"), F.col("source"), F.col("n_chars"),
    )
