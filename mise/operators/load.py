"""Set-based normalise / dedupe / merge into the four-table model.

Each operator returns the new state of a table (or a violation / outcome table) instead of
writing row by row.  Parquet has no MERGE, so a load computes the new rows and appends them (see
:mod:`mise.streaming.incremental`); a failed or lost task is simply recomputed.
Dimensions are built set-wise before facts, so parallel loads cannot race on check-then-insert.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as SCH
from ..session import cut_lineage
from .keys import dense_ids, max_id


# ---------------------------------------------------------------------------------------- L1
def resolve_title_col(*candidates: Column | str, default: str = "Untitled Recipe") -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in candidates]
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(default))


def resolve_title(df: DataFrame, record_title: str, meta_title: str, out: str = "title") -> DataFrame:
    return df.withColumn(out, resolve_title_col(record_title, meta_title))


# ---------------------------------------------------------------------------------- L2 / L3
def insert_absent(existing: DataFrame, new: DataFrame, key: str = "title", id_col: str = "id"):
    """(to_insert, already_present): rows whose key is absent, and the others with the id of the
    existing row (the smallest, as keys need not be unique)."""
    ids = existing.groupBy(key).agg(F.min(id_col).alias("existing_id"))
    return new.join(ids, key, "left_anti"), new.join(ids, key, "inner")


def first_per_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key (``row_number() = 1``; Spark limits each group map-side)."""
    key = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*key).orderBy(*[F.col(o) if isinstance(o, str) else o for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def duplicates_of_first(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """Rows that lose to an earlier row with the same key (reported as 'existing').

    ``order`` must identify a row (e.g. dataset, entry number).  The losers are an anti join
    against the winners on that identity, so a key owning a third of the rows is spread over
    all tasks instead of being sorted in one (``row_number() > 1`` cannot be limited map-side).
    """
    winners = first_per_key(df, key, order).select(*order)
    return df.join(winners, list(order), "left_anti")


# ---------------------------------------------------------------------------------- L4 / L5
def upsert_dimension(dim: DataFrame, names: DataFrame, name_col: str = "name",
                     defaults: Mapping[str, Column] | None = None, now: Column | None = None) -> DataFrame:
    """Get-or-create by name: new distinct names get ids after the current maximum, in name
    order, and are appended.  Returns the new dimension state."""
    now = now if now is not None else F.current_timestamp()
    fresh = (names.select(F.col(name_col).alias("name")).filter(F.col("name").isNotNull()).distinct()
                  .join(dim.select("name"), "name", "left_anti"))
    numbered = dense_ids(fresh, ["name"], start=max_id(dim))
    cols = []
    for f in dim.schema.fields:
        if f.name in ("id", "name"):
            cols.append(F.col(f.name))
        elif defaults and f.name in defaults:
            cols.append(defaults[f.name].cast(f.dataType).alias(f.name))
        elif f.name in ("created_at", "updated_at"):
            cols.append(now.cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return dim.unionByName(numbered.select(*cols))


# ---------------------------------------------------------------------------------------- L6
def build_junction(dishes: DataFrame, ingredients: DataFrame, measurements: DataFrame,
                   now: Column | None = None) -> DataFrame:
    """Junction rows from dishes with a nested ``ingredients`` array of
    struct<name, unit, amount, notes, order_index>: names resolve to ids (a missing name becomes
    'Unknown Ingredient'), units to measurement ids (NULL when absent), order from the position
    when order_index is 0 or NULL."""
    now = now if now is not None else F.current_timestamp()
    lines = dishes.select(F.col("id").alias("dish_id"), F.posexplode("ingredients").alias("pos", "e"))
    lines = lines.select(
        "dish_id",
        F.coalesce(F.nullif(F.col("e.name"), F.lit("")), F.lit("Unknown Ingredient")).alias("_name"),
        F.col("e.unit").alias("_unit"),
        F.col("e.amount").try_cast("decimal(10,3)").alias("amount"),
        F.col("e.notes").alias("notes"),
        F.coalesce(F.nullif(F.col("e.order_index"), F.lit(0)), F.col("pos") + 1).cast("int").alias("order_index"))
    i = ingredients.select(F.col("id").alias("ingredient_id"), F.col("name").alias("_name"))
    m = measurements.select(F.col("id").alias("measurement_id"), F.col("name").alias("_unit"))
    return (lines.join(i, "_name", "left").join(m, "_unit", "left")
                 .select("dish_id", "ingredient_id", "measurement_id", "amount", "notes", "order_index",
                         now.alias("created_at")))


# ------------------------------------------------------------------------------------ L7 - L9
def insert_ignore(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """INSERT ... ON CONFLICT DO NOTHING: new rows with unseen keys are appended once (of several
    with a key the least, column by column)."""
    keys = list(keys)
    others = [c for c in new.columns if c not in keys]
    if others:
        least = new.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row")).select(*keys, "_row.*").select(*new.columns)
    else:
        least = new.distinct()
    add = least.join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(add, allowMissingColumns=True)


def update_columns(df: DataFrame, updates: DataFrame, key: str = "id", now: Column | None = None) -> DataFrame:
    """Partial bulk update: columns present in ``updates`` are set for matching keys, others
    kept; ``updated_at`` is bumped on matched rows.  Of several updates with a key the greatest,
    column by column, counts."""
    now = now if now is not None else F.current_timestamp()
    supplied = [c for c in updates.columns if c != key and c in df.columns]
    u = updates.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_u_{c}") for c in supplied])
    if supplied:
        u = u.groupBy("_k").agg(F.max(F.struct(*[f"_u_{c}" for c in supplied])).alias("_u")).select("_k", "_u.*")
    else:
        u = u.distinct()
    j = df.join(u, df[key] == u["_k"], "left")
    hit = F.col("_k").isNotNull()
    cols = []
    for f in df.schema.fields:
        if f.name in supplied:
            cols.append(F.when(hit, F.col(f"_u_{f.name}")).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name))
        elif f.name == "updated_at":
            cols.append(F.when(hit, now).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return j.select(*cols)


def replace_children(junction: DataFrame, new: DataFrame, key: str = "dish_id") -> DataFrame:
    """Replace the child rows of every parent that appears in ``new``."""
    parents = new.select(key).distinct()
    return junction.join(parents, key, "left_anti").unionByName(new, allowMissingColumns=True)


# --------------------------------------------------------------------------------------- L10
@dataclass
class Rule:
    name: str
    kind: str            # not_null | max_length | in_list | unique | fk
    column: str
    arg: object = None   # length, allowed values, or (ref_df, ref_col)


def check_constraints(df: DataFrame, rules: Sequence[Rule], key: str = "id") -> DataFrame:
    """(rule, key, value) for every violation; NULL passes CHECK / length / FK like SQL."""
    out = None
    for r in rules:
        c = F.col(r.column)
        if r.kind == "not_null":
            bad = df.filter(c.isNull())
        elif r.kind == "max_length":
            bad = df.filter(F.length(c) > r.arg)
        elif r.kind == "in_list":
            bad = df.filter(c.isNotNull() & ~c.isin(list(r.arg)))
        elif r.kind == "unique":
            dup = df.filter(c.isNotNull()).groupBy(r.column).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
            bad = df.join(dup.select(r.column), r.column, "left_semi")
        elif r.kind == "fk":
            ref, ref_col = r.arg
            bad = df.filter(c.isNotNull()).join(ref.select(F.col(ref_col).alias(r.column)), r.column, "left_anti")
        else:
            raise ValueError(r.kind)
        v = bad.select(F.lit(r.name).alias("rule"), F.col(key).cast("string").alias("key"),
                       c.cast("string").alias("value"))
        out = v if out is None else out.unionByName(v)
    return out


# --------------------------------------------------------------------------------------- L11
def delete_dishes(dishes: DataFrame, junction: DataFrame, ids: DataFrame):
    """Delete dishes; their junction rows go too (cascade)."""
    ids = ids.select(F.col(ids.columns[0]).alias("id")).distinct()
    return (dishes.join(ids, "id", "left_anti"),
            junction.join(ids.withColumnRenamed("id", "dish_id"), "dish_id", "left_anti"))


def delete_ingredients(ingredients: DataFrame, junction: DataFrame, ids: DataFrame):
    """Delete ingredients; junction rows that use them are removed (cascade)."""
    ids = ids.select(F.col(ids.columns[0]).alias("id")).distinct()
    return (ingredients.join(ids, "id", "left_anti"),
            junction.join(ids.withColumnRenamed("id", "ingredient_id"), "ingredient_id", "left_anti"))


def delete_measurements(measurements: DataFrame, junction: DataFrame, ids: DataFrame):
    """Delete measurements; junction rows keep their line with ``measurement_id`` set NULL."""
    ids = ids.select(F.col(ids.columns[0]).alias("id")).distinct()
    gone = ids.select(F.col("id").alias("_gone"))
    j = junction.join(gone, junction["measurement_id"] == gone["_gone"], "left")
    j = j.withColumn("measurement_id", F.when(F.col("_gone").isNull(), F.col("measurement_id"))).drop("_gone")
    return measurements.join(ids, "id", "left_anti"), j


# --------------------------------------------------------------------------------------- L12
@dataclass
class Tables:
    dishes: DataFrame
    dish_ingredients: DataFrame
    ingredients: DataFrame
    measurements: DataFrame


# FIXED VALUES: longest texts of the tables' columns, and the values that two of them may have.
MAX_LENGTHS = {"title": 500, "difficulty": 20, "cuisine_type": 100, "meal_type": 20, "post_id": 50, "post_author": 100}
MAX_NAME, MAX_UNIT = 200, 50


def row_error(columns: Sequence[str]) -> Column:
    """Why a row can't be loaded, or NULL: the first rule of the four tables that it breaks."""
    checks = [F.when(F.col("title").isNull(), F.lit("title missing"))] if "title" in columns else []
    checks += [F.when(F.length(c) > n, F.lit(f"{c} too long")) for c, n in MAX_LENGTHS.items() if c in columns]
    checks += [F.when(F.col(c).isNotNull() & ~F.col(c).isin(values), F.lit(f"{c} not allowed"))
               for c, values in (("difficulty", SCH.DIFFICULTY_VALUES), ("meal_type", SCH.MEAL_TYPE_VALUES)) if c in columns]
    if "ingredients" in columns:
        def some(bad) -> Column:
            return F.exists("ingredients", lambda e: F.coalesce(bad(e), F.lit(False)))

        checks += [F.when(some(lambda e: F.length(e["name"]) > MAX_NAME), F.lit("ingredient name too long")),
                   F.when(some(lambda e: F.length(e["unit"]) > MAX_UNIT), F.lit("unit too long")),
                   F.when(some(lambda e: e["amount"].isNotNull() & e["amount"].try_cast("decimal(10,3)").isNull()),
                          F.lit("amount out of range"))]
    return F.coalesce(*([F.col("error")] if "error" in columns else []), *checks, F.lit(None).cast("string"))


def load_stage(rows: DataFrame, tables: Tables, now: Column | None = None,
               materialize: bool = True) -> tuple[Tables, DataFrame]:
    """Full load of dish rows (the output of ``to_dish_rows``) into the four tables.

    Rows that break a rule of the tables (:func:`row_error`) fail by themselves.  Of the others:
    dedupe titles inside the batch (first entry wins), skip titles already present, number new
    dishes after the current max id, get-or-create ingredients and measurements, then build
    junction rows.  Returns the new table states and one outcome row per entry: ``inserted``,
    ``existing`` (with the id of the dish that has the title, also if it came in this batch) or
    ``failed`` with its ``error``; a title already present is ``existing`` whatever else the row holds.
    Loading the same batch twice inserts nothing the second time.

    With ``materialize`` the batch is checkpointed once (into the shared checkpoint folder):
    it feeds several branches (winners, losers, numbering, dimensions), which then read the
    same rows instead of recomputing the batch's upstream plan for each.
    """
    now = now if now is not None else F.current_timestamp()
    rows = rows.withColumn("error", row_error(rows.columns))
    if materialize:
        rows = cut_lineage(rows)
    order = [c for c in ("dataset", "entryNumber") if c in rows.columns] or ["title"]
    unseen, present = insert_absent(tables.dishes, rows, "title")
    failed = unseen.where("error is not null")
    good = unseen.where("error is null")
    # Whole rows are limited to the first of each title where they are read, before anything deals them
    # out by title: few titles may own the batch.
    first, _ = insert_absent(tables.dishes, first_per_key(rows.where("error is null"), "title", order), "title")
    numbered = dense_ids(first, order, start=max_id(tables.dishes))
    dup = good.join(numbered.select(*order), order, "left_anti")
    rcols = []
    for f in tables.dishes.schema.fields:
        if f.name in numbered.columns:
            rcols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in ("created_at", "updated_at"):
            rcols.append(now.cast(f.dataType).alias(f.name))
        else:
            rcols.append(F.lit(None).cast(f.dataType).alias(f.name))
    new_dishes = numbered.select(*rcols)
    lines = numbered.select("id", F.explode("ingredients").alias("e"))
    names = lines.select(F.coalesce(F.nullif(F.col("e.name"), F.lit("")), F.lit("Unknown Ingredient")).alias("name"))
    units = lines.select(F.col("e.unit").alias("name"))
    ingredients = upsert_dimension(tables.ingredients, names, now=now)
    measurements = upsert_dimension(tables.measurements, units, now=now)
    junction = build_junction(numbered.select("id", "ingredients"), ingredients, measurements, now)
    out_tables = Tables(tables.dishes.unionByName(new_dishes),
                        tables.dish_ingredients.unionByName(junction, allowMissingColumns=True),
                        ingredients, measurements)
    keys = [c for c in ("dataset", "entryNumber") if c in rows.columns]

    def outcomes(df: DataFrame, dish_id: Column, status: str, error: Column | None = None) -> DataFrame:
        return df.select(*keys, "title", dish_id.cast("bigint").alias("dish_id"), F.lit(status).alias("status"),
                         (error if error is not None else F.lit(None).cast("string")).alias("error"))

    winners = numbered.select("title", F.col("id").alias("winner_id"), F.struct(*order).alias("winner"))
    # A row that can't be loaded only fails if its title isn't there by its turn.
    failed = failed.join(winners, "title", "left").withColumn("_late", F.coalesce(F.struct(*order) > F.col("winner"), F.lit(False)))
    late, early = failed.where("_late"), failed.where("not _late")
    outcome = (outcomes(numbered, F.col("id"), "inserted")
               .unionByName(outcomes(present, F.col("existing_id"), "existing"))
               .unionByName(outcomes(dup.join(winners, "title"), F.col("winner_id"), "existing"))
               .unionByName(outcomes(late, F.col("winner_id"), "existing"))
               .unionByName(outcomes(early, F.lit(None), "failed", F.col("error"))))
    return out_tables, outcome


# --------------------------------------------------------------------------------------- L13
def quality_report(dishes: DataFrame, junction: DataFrame) -> DataFrame:
    """Dishes, NULL titles, dishes without ingredient lines, junction rows (one row)."""
    has = junction.select(F.col("dish_id").alias("id")).distinct()
    with_lines = dishes.join(has.withColumn("_has", F.lit(True)), "id", "left")
    jrows = junction.select(F.count(F.lit(1))).scalar()
    return with_lines.agg(F.count(F.lit(1)).alias("dishes"),
                          F.count_if(F.col("title").isNull()).alias("null_titles"),
                          F.count_if(F.col("_has").isNull()).alias("without_ingredients")).withColumn(
        "junction_rows", jrows)
