"""Relational operators over the normalised tables.

Tables use the canonical column names of ``mise.schemas``: ``dishes(id, title, ...)``,
``dish_ingredients(dish_id, ingredient_id, measurement_id, amount, notes, order_index)``,
``ingredients(id, name, category)``, ``measurements(id, name, unit_type)``.

Joins are declared, not hinted: dimension tables are broadcast by AQE only when their runtime
size is under ``spark.sql.autoBroadcastJoinThreshold`` and fall back to a shuffle join
otherwise; AQE's skew-join split handles an ingredient id that owns a large share of the
junction rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.analysis import Analyzer, english_porter
from . import index as IX


def _order(cols: Sequence) -> list[Column]:
    out = []
    for c in cols:
        if isinstance(c, Column):
            out.append(c)
        elif isinstance(c, tuple):
            name, direction = c
            out.append(F.col(name).desc_nulls_last() if direction == "desc" else F.col(name).asc_nulls_last())
        else:
            out.append(F.col(c).asc_nulls_last())
    return out


# ------------------------------------------------------------------------------------- R1 / R2
def ingredient_lines(junction: DataFrame, ingredients: DataFrame, measurements: DataFrame,
                     tie_break: Sequence[str] = (), units: bool = True) -> DataFrame:
    """Junction rows with ingredient and unit names resolved (left joins: unknown ids stay)."""
    i = ingredients.select(F.col("id").alias("ingredient_id"), F.col("name").alias("ingredient_name"),
                           F.col("id").alias("_iid"))
    m = measurements.select(F.col("id").alias("measurement_id"), F.col("name").alias("unit_name"),
                            F.col("id").alias("_mid"))
    extra = [c for c in tie_break if c in junction.columns]
    j = junction.select("dish_id", "ingredient_id", "measurement_id", "amount", "notes", "order_index", *extra)
    named = j.join(i, "ingredient_id", "left")
    return named.join(m, "measurement_id", "left") if units else named


def _ids_once(df: DataFrame) -> bool:
    """No two rows share an id (rows without one meet nothing in a join)."""
    return df.where(F.col("id").isNotNull()).groupBy("id").count().where("count > 1").isEmpty()


def dish_rows(dishes: DataFrame, junction: DataFrame, ingredients: DataFrame, measurements: DataFrame,
                dish_cols: Sequence[str] = ("id", "title")) -> DataFrame:
    """One row per (dish, ingredient line); dishes without ingredients keep one row of NULLs."""
    lines = ingredient_lines(junction, ingredients, measurements)
    r = dishes.select(*dish_cols)
    return (r.join(lines, r["id"] == lines["dish_id"], "left")
             .select(*[r[c] for c in dish_cols], "order_index", "ingredient_name", "unit_name", "amount", "notes"))


#: What an entry of a dish's nested ingredients holds, and its types.
INGREDIENT_PARTS = {"name": "string", "quantity": "double", "unit": "string", "notes": "string"}


def _ingredient_struct(tie_break: Sequence[str], parts: Sequence[str]) -> Column:
    of = {"name": F.col("ingredient_name"), "quantity": F.col("amount").cast("double"), "unit": F.col("unit_name"), "notes": F.col("notes")}
    return F.struct(F.col("order_index").alias("_o"), *[F.col(c).alias(f"_t{k}") for k, c in enumerate(tie_break)],
                    *[of[p].alias(p) for p in parts])


def nested_ingredients(junction: DataFrame, ingredients: DataFrame, measurements: DataFrame,
                       tie_break: Sequence[str] = (), parts: Sequence[str] | None = None) -> DataFrame:
    """(dish_id, ingredients) with ingredients ordered by order_index (then ``tie_break``).

    Lines whose ingredient id does not resolve are left out (aggregate FILTER semantics).  The
    grouping is by dish only, and the list of a dish is bounded by that dish's lines.  ``parts``: the
    entries hold no more than these.  Then columns that change nothing are left behind before the
    shuffles, and lines are dealt out by dish as they are rather than as lists, which are wider where
    a join has put the lines of a dish apart.
    """
    units, tie_break = True, list(tie_break)
    if parts is not None:
        # A left join whose columns are not read does nothing but repeat lines, if ids do.
        units = "unit" in parts or not _ids_once(measurements)
        if list(parts) == ["name"] and "ingredient_id" in tie_break and _ids_once(ingredients):
            # Lines that tie up to their ingredient have one name: what would order them orders equal entries.
            tie_break = tie_break[:tie_break.index("ingredient_id") + 1]
    lines = ingredient_lines(junction, ingredients, measurements, tie_break, units).filter(F.col("_iid").isNotNull())
    if parts is not None:
        lines = lines.repartition("dish_id")
    parts = list(parts or INGREDIENT_PARTS)
    agg = lines.groupBy("dish_id").agg(F.array_sort(F.collect_list(_ingredient_struct(tie_break, parts))).alias("_l"))
    return agg.select("dish_id", F.transform("_l", lambda s: F.struct(*[s[p].alias(p) for p in parts])).alias("ingredients"))


def nest_dishes(dishes: DataFrame, junction: DataFrame, ingredients: DataFrame, measurements: DataFrame,
                 tie_break: Sequence[str] = (), parts: Sequence[str] | None = None) -> DataFrame:
    """R2: dishes with a nested, ordered ingredient array; a dish without lines gets ``[]``."""
    nested = nested_ingredients(junction, ingredients, measurements, tie_break, parts)
    empty = F.array().cast(f"array<struct<{','.join(f'{p}:{INGREDIENT_PARTS[p]}' for p in parts or INGREDIENT_PARTS)}>>")
    return (dishes.join(nested, dishes["id"] == nested["dish_id"], "left")
                   .withColumn("ingredients", F.coalesce(F.col("ingredients"), empty))
                   .drop("dish_id"))


DOCUMENT_COLUMNS = ["id", "title", "description", "ingredients", "instructions", "prep_time_minutes",
                    "cook_time_minutes", "total_time_minutes", "servings", "difficulty", "cuisine_type", "meal_type",
                    "dietary_tags", "post_author", "post_score", "post_comments", "created_at",
                    "updated_at"]


def build_documents(dishes: DataFrame, junction: DataFrame, ingredients: DataFrame, measurements: DataFrame,
                    tie_break: Sequence[str] = (), parts: Sequence[str] | None = None) -> DataFrame:
    """Search documents, one per dish, servings as double, missing columns as NULL.  ``parts``: the parts of the nested
    ingredients that will be read, if not all."""
    docs = nest_dishes(dishes, junction, ingredients, measurements, tie_break, parts)
    cols = []
    for c in DOCUMENT_COLUMNS:
        if c in docs.columns:
            cols.append(F.col(c).cast("double").alias(c) if c == "servings" else F.col(c))
        else:
            cols.append(F.lit(None).alias(c))
    return docs.select(*cols)


# ------------------------------------------------------------------------------------- R3 - R10
def by_ids(df: DataFrame, ids, key: str = "id") -> DataFrame:
    """Rows whose key is in ``ids`` (a Python list -> ``isin``; a DataFrame -> semi join)."""
    if isinstance(ids, DataFrame):
        other = ids.select(F.col(ids.columns[0]).alias(key)).distinct()
        return df.join(other, key, "left_semi")
    return df.filter(F.col(key).isin(list(ids)))


def by_name(df: DataFrame, name: str, column: str = "name") -> DataFrame:
    """Exact name lookup."""
    return df.filter(F.col(column) == F.lit(name))


def filter_dishes(df: DataFrame, cuisine_type=None, meal_type=None, difficulty=None, dietary_tags=None,
                   max_prep_time=None, max_cook_time=None, min_servings=None) -> DataFrame:
    """Optional conjunctive filters; NULL values never pass a bound (SQL semantics)."""
    cond = F.lit(True)
    for c, v in (("cuisine_type", cuisine_type), ("meal_type", meal_type), ("difficulty", difficulty)):
        if v is not None:
            cond = cond & (F.col(c) == F.lit(v))
    if dietary_tags:
        cond = cond & F.coalesce(F.arrays_overlap("dietary_tags", F.array(*[F.lit(t) for t in dietary_tags])),
                                 F.lit(False))
    if max_prep_time is not None:
        cond = cond & (F.col("prep_time_minutes") <= max_prep_time)
    if max_cook_time is not None:
        cond = cond & (F.col("cook_time_minutes") <= max_cook_time)
    if min_servings is not None:
        cond = cond & (F.col("servings") >= min_servings)
    return df.filter(F.coalesce(cond, F.lit(False)))


def page(df: DataFrame, order: Sequence, limit: int = 50, offset: int = 0) -> DataFrame:
    """Order, then offset/limit (planned as a top-k, never a global sort + collect)."""
    out = df.orderBy(*_order(order))
    if offset:
        out = out.offset(offset)
    return out.limit(limit)


def list_dimension(df: DataFrame, category: str | None = None, unit_type: str | None = None,
                   limit: int = 100, offset: int = 0) -> DataFrame:
    """Optional category / unit type filter, name order (id breaks ties)."""
    if category is not None:
        df = df.filter(F.col("category") == category)
    if unit_type is not None:
        df = df.filter(F.col("unit_type") == unit_type)
    return page(df, ["name", "id"], limit, offset)


def ilike_search(df: DataFrame, term: str, cols: Sequence[str] = ("name", "description")) -> DataFrame:
    """Case-insensitive substring on any of ``cols``."""
    pattern = "%" + term.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
    cond = None
    for c in cols:
        p = F.coalesce(F.col(c).ilike(pattern), F.lit(False))
        cond = p if cond is None else (cond | p)
    return df.filter(cond)


#: What the weights 1 / j^2 of a term's occurrences add up to at most.
RANK_SCALE = 1.64493406685


def text_search(df: DataFrame, term: str, cols: Sequence[str] = ("title", "description"), limit: int = 50,
                key: str = "id", weight: float = 0.1, normalization: int = 0, analyzer: Analyzer = english_porter) -> DataFrame:
    """Every analysed query term must occur in the analysed text of ``cols``; best rank first, key breaking ties.

    The rank is the database's frequency form: the j-th occurrence of a term adds ``weight`` / j^2, scaled to at most
    ``weight``, averaged over the query's terms.  ``normalization`` 1 divides it by 1 + ln(length), 2 by the length
    in terms (the database's flags of these numbers).  Only the query's terms reach the shuffle."""
    if normalization not in (0, 1, 2):
        raise ValueError("normalization is 0, 1 or 2")
    text = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in cols])
    source = IX.DocumentIndex(df.select(F.col(key).alias("id"), text.alias("text")), [IX.text_field("text", analyzer)])
    terms = IX.query_terms(source, term, {"text": weight})
    wanted = terms.select(F.count(F.lit(1))).scalar()
    weights = F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.col("tf")), F.lit(0.0), lambda a, j: a + F.lit(1.0) / (j * j))
    length = {0: F.lit(1.0), 1: F.lit(1.0) + F.log(F.first("dl").cast("double")), 2: F.first("dl").cast("double")}[normalization]
    ranked = source.lookup(terms).postings.groupBy("id").agg(
        F.count(F.lit(1)).alias("_found"), (F.sum(F.lit(weight) * weights / F.lit(RANK_SCALE)) / F.count(F.lit(1)) / length).alias("rank"))
    ranked = ranked.where(F.col("_found") == wanted).withColumn("rank", F.round("rank", 9))
    best = ranked.orderBy(F.desc("rank"), F.asc("id")).limit(limit).select(F.col("id").alias("_id"), "rank")
    # At most ``limit`` rows.
    return df.join(F.broadcast(best), df[key] == best["_id"]).drop("_id").orderBy(F.desc("rank"), F.asc(key))


# ------------------------------------------------------------------------------------ R12 - R17
def dish_stats(df: DataFrame) -> DataFrame:
    """One aggregate row."""
    return df.agg(
        F.count(F.lit(1)).alias("total_dishes"),
        F.count_distinct("cuisine_type").alias("unique_cuisines"),
        F.count_distinct("meal_type").alias("unique_meal_types"),
        F.round(F.avg("prep_time_minutes"), 6).alias("avg_prep_time"),
        F.round(F.avg("cook_time_minutes"), 6).alias("avg_cook_time"),
        F.round(F.avg("total_time_minutes"), 6).alias("avg_total_time"),
        F.round(F.avg(F.col("servings").cast("double")), 6).alias("avg_servings"),
    )


def facet_counts(df: DataFrame, column: str, drop_null: bool = False) -> DataFrame:
    """Count per value, most frequent first (value ascending breaks ties)."""
    if drop_null:
        df = df.filter(F.col(column).isNotNull())
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc_nulls_last(column))


def recent(df: DataFrame, n: int = 10, ts: str = "created_at", key: str = "id") -> DataFrame:
    """Newest ``n`` (top-k, id descending breaks ties)."""
    return df.orderBy(F.col(ts).desc_nulls_last(), F.col(key).desc()).limit(n)


def count_since(df: DataFrame, ts: str, now: _dt.datetime | str, interval: str = "1 hour") -> DataFrame:
    """Rows with ``ts`` within ``interval`` before ``now`` (``now`` is explicit for determinism;
    it takes the column's own timestamp type, so the session time zone plays no part)."""
    start = F.lit(now).cast(df.schema[ts].dataType) - F.expr(f"INTERVAL {interval}")
    return df.filter(F.col(ts) >= start).agg(F.count(F.lit(1)).alias("count"))


def count_by(df: DataFrame, column: str, like: str | None = None) -> DataFrame:
    """Count per value of ``column`` among rows matching a LIKE pattern."""
    if like is not None:
        df = df.filter(F.col(column).like(like))
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column)


def avg_children(dishes: DataFrame, junction: DataFrame, as_zero: bool = False, fk: str = "dish_id") -> DataFrame:
    """Dishes, distinct cuisines and average ingredient lines per dish.

    Lines are counted per dish first (partial aggregation), then left-joined; dishes without
    lines are excluded from the average unless ``as_zero``.
    """
    counts = junction.groupBy(fk).agg(F.count(F.lit(1)).alias("_n"))
    j = dishes.select("id", "cuisine_type").join(counts, dishes["id"] == counts[fk], "left")
    n = F.coalesce(F.col("_n"), F.lit(0)) if as_zero else F.col("_n")
    return j.agg(F.count(F.lit(1)).alias("total_dishes"),
                 F.count_distinct("cuisine_type").alias("unique_cuisines"),
                 F.round(F.avg(n), 6).alias("avg_ingredients_per_dish"))
