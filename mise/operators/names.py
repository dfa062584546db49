"""Substring filters that look at names before mentions, and completions by prefix.

A collection has few names and many mentions of them.  ``name_table`` keeps each distinct name once, and
``gram_table`` the three-character pieces of each.  A pattern's pieces prune the names, the exact test
decides on those left, and only then are mentions met, by equality of names.  Patterns whose literal runs are
all shorter than a piece are tested on all distinct names.

``suggestions`` keeps the first titles of each prefix, so that a completion reads one row group and no titles.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .search import wildcard

GRAM = 3


# ------------------------------------------------------------------------------------ names, pieces
def folded(text: Column) -> Column:
    """Lower case; the two small sigmas are one letter, as which of them it is depends on what follows."""
    return F.translate(F.lower(text), "ς", "σ")


def grams(text: Column) -> Column:
    """The distinct pieces of a folded text."""
    return F.when(F.length(text) >= GRAM, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - (GRAM - 1)), lambda i: text.substr(i, F.lit(GRAM))))).otherwise(F.array().cast("array<string>"))


def name_table(mentions: DataFrame, name: str = "name") -> DataFrame:
    """Each distinct name once, null left out."""
    return mentions.where(F.col(name).isNotNull()).select(F.col(name).alias("name")).distinct()


def gram_table(names: DataFrame) -> DataFrame:
    """(gram, name): the pieces of each name."""
    return names.select(F.explode(grams(folded(F.col("name")))).alias("gram"), "name")


def literal_runs(pattern: str) -> list[str]:
    return [r for r in re.split(r"[*?]+", pattern) if r]


def matching_names(names: DataFrame, pieces: DataFrame, pattern: str, case_insensitive: bool = True, test: Column | None = None) -> DataFrame:
    """The names that a wildcard pattern matches: pruned by pieces, then tested (by ``test`` if another one decides)."""
    spark = names.sparkSession
    test = wildcard("name", pattern, case_insensitive) if test is None else test
    runs = [r for r in literal_runs(pattern) if len(r) >= GRAM]
    if not runs:
        return names.where(test)
    wanted = spark.range(1).select(F.explode(F.array_distinct(F.flatten(F.array(*[grams(folded(F.lit(r))) for r in runs])))).alias("gram"))
    need = wanted.agg(F.count(F.lit(1))).scalar()
    # The pattern's own pieces.
    held = pieces.join(F.broadcast(wanted), "gram").groupBy("name").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == need)
    return held.select("name").where(test)


def ids_with_name(mentions: DataFrame, names: DataFrame, pieces: DataFrame, pattern: str) -> DataFrame:
    """(id) of the mentions (id, name) whose name matches, each once."""
    return mentions.join(matching_names(names, pieces, pattern), "name", "left_semi").select("id").distinct()


def ingredient_filter_names(ids: DataFrame, mentions: DataFrame, names: DataFrame, pieces: DataFrame, spec) -> DataFrame:
    """The boolean filter of :func:`mise.operators.search.ingredient_filter` over (id, name) mentions."""
    if isinstance(spec, str):
        return ids.join(ids_with_name(mentions, names, pieces, f"*{spec}*"), "id", "left_semi")
    op, *args = spec
    parts = [ingredient_filter_names(ids, mentions, names, pieces, a) for a in args]
    if op == "not":
        return ids.join(parts[0], "id", "left_anti")
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "id", "left_semi") if op == "and" else out.unionByName(p).distinct()
    return out


def ilike_names(df: DataFrame, term: str, cols: Sequence[str], tables: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows with ``term`` in one of ``cols``, each of which has its names and pieces in ``tables``."""
    cond, out, own = F.lit(False), df, []
    for i, c in enumerate(cols):
        names, pieces = tables[c]
        # A term's own * is any character to the pattern; the exact test decides.
        like = "%" + term.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
        hits = matching_names(names, pieces, f"*{term.replace('*', '?')}*", test=F.col("name").ilike(like))
        out = out.join(hits.select(F.col("name").alias(f"_n{i}")), out[c] == F.col(f"_n{i}"), "left")
        cond = cond | F.col(f"_n{i}").isNotNull()
        own.append(f"_n{i}")
    return out.where(cond).drop(*own)


# ---------------------------------------------------------------------------------- completions
LONGEST_PREFIX, KEPT = 8, 10


def suggestions(docs: DataFrame, field: str = "title", key: str = "id", longest: int = LONGEST_PREFIX, kept: int = KEPT) -> DataFrame:
    """(prefix, nth, id, title): the first ``kept`` titles, by title and key, of each prefix of up to ``longest`` characters.
    A prefix that a third of all titles have is cut to ``kept`` rows per task before the shuffle."""
    low = F.lower("_title")
    prefixes = F.transform(F.sequence(F.lit(1), F.least(F.length(low), F.lit(longest))), lambda i: low.substr(F.lit(1), i))
    rows = docs.select(F.col(key).alias("_id"), F.col(field).alias("_title")).where(F.length(low) > 0)
    rows = rows.select("_id", "_title", F.explode(prefixes).alias("prefix")).withColumnsRenamed({"_id": "id", "_title": "title"})
    first = Window.partitionBy("prefix").orderBy("title", "id")
    return rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= kept).select("prefix", "nth", "id", "title")


def write_suggestions(table: DataFrame, path: str, buckets: int = 32) -> None:
    """Stored by bucket of the prefix."""
    spread = table.withColumn("bucket", F.pmod(F.xxhash64("prefix"), F.lit(buckets)).cast("int")).withColumn("buckets", F.lit(buckets))
    spread.repartition("bucket").write.mode("overwrite").partitionBy("buckets", "bucket").parquet(path)


def suggest_stored(spark: SparkSession, path: str, prefix: str, n: int = 5) -> DataFrame:
    """S34 from the stored table: (id, title) of the first ``n`` titles that start with ``prefix``."""
    if not 0 < len(prefix) <= LONGEST_PREFIX or n > KEPT:
        raise ValueError(f"the table answers for prefixes of 1 to {LONGEST_PREFIX} characters and up to {KEPT} titles; "
                         "search.suggest reads the titles for others")
    table = spark.read.parquet(path)
    low = F.lower(F.lit(prefix))
    mine = table.where((F.col("bucket") == F.pmod(F.xxhash64(low), F.col("buckets")).cast("int")) & (F.col("prefix") == low) & (F.col("nth") <= n))
    return mine.orderBy("nth").select("id", "title")
