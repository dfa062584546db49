"""Aggregations over search documents.

Nested ingredient aggregations explode the array row-locally, then group.  Every grouping is
partially aggregated before its shuffle, and every top-k-per-group is a ``row_number() <= k``
that Spark plans with a partial ``WindowGroupLimit`` before the exchange, so a group holding a
third of all rows still ships at most k rows per map partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mentions(docs: DataFrame, cols: Sequence[str] = ("id",), field: str = "name") -> DataFrame:
    """Flat (cols..., name) rows, one per ingredient mention (NULL names kept; aggs skip them).

    ``docs`` is either nested documents (an ``ingredients`` array, exploded row-locally) or
    already flat mentions (a ``name`` column, e.g. junction rows joined to names and dish
    columns), which is the form to use at scale: no per-dish array is ever built.
    """
    if "ingredients" not in docs.columns and field in docs.columns:
        return docs.select(*cols, field)
    return docs.select(*cols, F.explode("ingredients").alias("_e")).select(*cols, F.col("_e")[field].alias(field))


def value_count(df: DataFrame, column: str, alias: str = "value_count") -> DataFrame:
    """G1."""
    return df.agg(F.count(column).alias(alias))


def cardinality(df: DataFrame, column: str, approx: bool = True, alias: str = "cardinality") -> DataFrame:
    """HyperLogLog++ by default (as the search engine), exact when ``approx=False``."""
    f = F.approx_count_distinct(column) if approx else F.count_distinct(column)
    return df.agg(f.alias(alias))


def top_terms(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Top ``n`` non-NULL values by count, key ascending on ties."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc(column)).limit(n))


def ingredient_totals(docs: DataFrame, approx: bool = False, flat: DataFrame | None = None) -> DataFrame:
    """Documents, ingredient mentions and unique ingredient names."""
    m = mentions(flat if flat is not None else docs)
    unique = F.approx_count_distinct("name") if approx else F.count_distinct("name")
    total_docs = docs.select(F.count("id")).scalar()
    return m.agg(F.count("name").alias("total_mentions"), unique.alias("unique_ingredients")) \
            .select(total_docs.alias("total_dishes"), "total_mentions", "unique_ingredients")


def top_ingredients(docs: DataFrame, n: int = 20) -> DataFrame:
    """G5."""
    return top_terms(mentions(docs), "name", n)


def ingredient_frequency(docs: DataFrame, n: int = 30, flat: DataFrame | None = None) -> DataFrame:
    """Mentions, distinct dishes and share of all dishes for the top ``n`` names.

    The total is a scalar subquery, not a cross join.
    """
    total = docs.select(F.count(F.lit(1))).scalar()
    m = mentions(flat if flat is not None else docs).filter(F.col("name").isNotNull())
    g = m.groupBy("name").agg(F.count(F.lit(1)).alias("mentions"), F.count_distinct("id").alias("dishes"))
    return (g.withColumn("percent", F.round(F.col("dishes") * 100.0 / total, 6))
             .orderBy(F.desc("mentions"), F.asc("name")).limit(n))


def top_per_group(docs: DataFrame, group: str, n_groups: int = 10, n: int = 10, only: str | None = None,
                  flat: DataFrame | None = None) -> DataFrame:
    """Top ``n`` ingredients inside each of the top ``n_groups`` groups.

    Group ranking counts documents; ingredient ranking counts mentions (taken from ``flat``
    (group, name) rows when given, else from the nested documents).  ``only`` keeps one group
    (the filter sits below the explode).
    """
    top = top_terms(docs, group, n_groups).select(group, F.col("count").alias("group_count"))
    src = flat if flat is not None else docs
    base = src.filter(F.col(group) == only) if only is not None else src
    # ``top`` has at most ``n_groups`` rows, so the broadcast is bounded by the argument.
    m = mentions(base.join(F.broadcast(top.select(group)), group, "left_semi"), cols=(group,))
    counts = m.filter(F.col("name").isNotNull()).groupBy(group, "name").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(group).orderBy(F.desc("count"), F.asc("name"))
    ranked = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    return ranked.join(F.broadcast(top), group)


def top_with_samples(docs: DataFrame, n: int = 50, k: int = 3, title: str = "title",
                     flat: DataFrame | None = None) -> DataFrame:
    """Top ``n`` ingredients, each with the ``k`` most frequent dish titles containing it
    (``flat``: (id, title, name) mention rows)."""
    m = mentions(flat if flat is not None else docs, cols=("id", title)).filter(F.col("name").isNotNull())
    top = m.groupBy("name").agg(F.count(F.lit(1)).alias("mentions"),
                                F.count_distinct("id").alias("dishes")).orderBy(F.desc("mentions"), "name").limit(n)
    per_title = (m.join(F.broadcast(top.select("name")), "name", "left_semi")
                  .filter(F.col(title).isNotNull())
                  .groupBy("name", title).agg(F.count_distinct("id").alias("title_count")))
    w = Window.partitionBy("name").orderBy(F.desc("title_count"), F.asc(title))
    best = per_title.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
    samples = best.groupBy("name").agg(
        F.array_sort(F.collect_list(F.struct("_r", F.col(title).alias("t")))).alias("_s"))
    return (top.join(samples, "name", "left")
               .select("name", "mentions", "dishes",
                       F.coalesce(F.transform("_s", lambda s: s["t"]), F.array().cast("array<string>")).alias("titles")))


def _mention_counts(docs: DataFrame, flat: DataFrame | None) -> tuple[DataFrame, Column]:
    """Documents with a per-document count of named ingredient mentions."""
    if flat is None:
        return docs, F.size(F.filter("ingredients", lambda e: e["name"].isNotNull()))
    per = flat.filter(F.col("name").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("_mentions"))
    return docs.join(per, "id", "left"), F.coalesce(F.col("_mentions"), F.lit(0))


def profile_by(docs: DataFrame, group: str = "difficulty", flat: DataFrame | None = None) -> DataFrame:
    """Per group: documents, average total time, ingredient mentions, average score."""
    docs, names = _mention_counts(docs, flat)
    return (docs.filter(F.col(group).isNotNull()).groupBy(group)
                .agg(F.count(F.lit(1)).alias("count"),
                     F.round(F.avg("total_time_minutes"), 6).alias("avg_time"),
                     F.sum(names).alias("ingredient_mentions"),
                     F.round(F.avg("post_score"), 6).alias("avg_score"))
                .orderBy(F.desc("count"), group))


def top_hits(docs: DataFrame, group: str = "cuisine_type", order: str = "post_score", k: int = 3,
             n_groups: int = 20, cols: Sequence[str] = ("title", "difficulty", "total_time_minutes")) -> DataFrame:
    """For each of the top groups, the ``k`` best documents by ``order`` (missing last)."""
    top = top_terms(docs, group, n_groups).select(group, F.col("count").alias("group_count"))
    w = Window.partitionBy(group).orderBy(F.col(order).desc_nulls_last(), F.asc("id"))
    best = (docs.join(F.broadcast(top.select(group)), group, "left_semi")
                .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))
    return best.select(group, "rank", "id", order, *cols).join(F.broadcast(top), group)


def sub_terms(docs: DataFrame, outer: str = "cuisine_type", inner: str = "difficulty",
              n_outer: int = 20, n_inner: int = 10) -> DataFrame:
    """Inner value counts inside each of the top outer values."""
    top = top_terms(docs, outer, n_outer).select(outer)
    counts = (docs.join(F.broadcast(top), outer, "left_semi").filter(F.col(inner).isNotNull())
                  .groupBy(outer, inner).agg(F.count(F.lit(1)).alias("count")))
    w = Window.partitionBy(outer).orderBy(F.desc("count"), F.asc(inner))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n_inner)


def filtered_mentions(docs: DataFrame, pred: Column | None = None, flat: DataFrame | None = None) -> DataFrame:
    """Ingredient mentions (non-NULL names) over the documents matching ``pred``."""
    d = docs.filter(pred) if pred is not None else docs
    d, names = _mention_counts(d, flat)
    return d.agg(F.coalesce(F.sum(names), F.lit(0)).alias("ingredient_mentions"), F.count(F.lit(1)).alias("hits"))
