"""Incremental loading with Structured Streaming.

The stage directory is a file source; each micro-batch goes through the same batch operators.
Tables are parquet partitioned by ``source`` (one stream's checkpoint, or the batch loads) and
``batch``.  A load removes what an earlier attempt at the same source and batch left, reads the
state of all committed loads, writes its rows, and last a row in ``commits``.  A load that failed
half way is in no one's state, and replaying it gives what a clean load gives.  Streams and batch
loads may take turns over one state; two at the same time may not.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as SCH
from ..functions.records import extract_posts, to_dish_rows
from ..operators import load as L
from ..operators.relational import build_documents
from ..sources.staging import STAGE_FILE_SCHEMA

TABLES = {"dishes": SCH.DISHES_TABLE, "dish_ingredients": SCH.DISH_INGREDIENTS_TABLE,
          "ingredients": SCH.INGREDIENTS_TABLE, "measurements": SCH.MEASUREMENTS_TABLE}


COMMITS = T.StructType([T.StructField("source", T.StringType()), T.StructField("batch", T.LongType())])


def read_commits(spark: SparkSession, base: str) -> DataFrame:
    """(source, batch) of every load that was completed."""
    return _read(spark, os.path.join(base, "commits"), COMMITS)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # With the schema given, nothing is read to find out whether the path is there.
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:  # nothing written yet
        return spark.createDataFrame([], schema)


def _committed(spark: SparkSession, base: str, name: str, schema: T.StructType) -> DataFrame:
    placed = T.StructType([*schema.fields, *COMMITS.fields])
    rows = _read(spark, os.path.join(base, name), placed)
    # One row per load: the join prunes the partitions of loads that weren't completed.
    return rows.join(read_commits(spark, base), ["source", "batch"], "left_semi").select(*schema.fieldNames())


def read_tables(spark: SparkSession, base: str) -> L.Tables:
    """Current state: the rows of every committed load (empty tables before the first)."""
    return L.Tables(**{name: _committed(spark, base, name, schema) for name, schema in TABLES.items()})


OUTCOMES = T.StructType([T.StructField(n, T.LongType() if n in ("entryNumber", "dish_id") else T.StringType())
                         for n in ("dataset", "entryNumber", "title", "dish_id", "status", "error")])


def read_outcomes(spark: SparkSession, base: str) -> DataFrame:
    return _committed(spark, base, "outcomes", OUTCOMES)


def _place(base: str, name: str, source: str, batch_id: int) -> str:
    return os.path.join(base, name, f"source={source}", f"batch={batch_id}")


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def load_batch(batch: DataFrame, batch_id: int, base: str, source: str = "batch") -> None:
    """One micro-batch: drop entries loaded before (key = dataset, entryNumber; failed ones
    may come again), then the full load (L12) against the committed state, writing only new rows."""
    spark = batch.sparkSession
    names = [*TABLES, "outcomes"]
    # The commit goes first, so that what is half removed isn't state either.
    for name in ("commits", *names):
        _remove(spark, _place(base, name, source, batch_id))
    done = read_outcomes(spark, base).where("status != 'failed'")
    tables = read_tables(spark, base)
    once = L.first_per_key(batch, ["dataset", "entryNumber"], [F.to_json(F.struct("metadata", "recipeData"))])
    fresh = once.join(done.select("dataset", "entryNumber"), ["dataset", "entryNumber"], "left_anti")
    new_tables, outcome = L.load_stage(to_dish_rows(fresh), tables)
    # Keep only this batch's rows: ids above the previous maxima, junction rows of new dishes.
    prev = {n: L.max_id(getattr(tables, n)) for n in ("dishes", "ingredients", "measurements")}
    new = {"dishes": new_tables.dishes.filter(F.col("id") > prev["dishes"]),
           "ingredients": new_tables.ingredients.filter(F.col("id") > prev["ingredients"]),
           "measurements": new_tables.measurements.filter(F.col("id") > prev["measurements"]),
           "dish_ingredients": new_tables.dish_ingredients.filter(F.col("dish_id") > prev["dishes"]),
           "outcomes": outcome.select(*OUTCOMES.fieldNames())}
    for name in names:
        write_rows(new[name], _place(base, name, source, batch_id))
    commit = spark.createDataFrame([(True,)], "done boolean").coalesce(1)
    write_rows(commit, _place(base, "commits", source, batch_id))


def write_rows(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def stream_stage(spark: SparkSession, stage_dir: str, base: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """Load staged JSON files as they appear (non-JSON files are ignored).  Batches are numbered
    by the stream's checkpoint, so its path names their source."""
    source = "stream-" + hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    # dataset / chunk come back from the partition directories written by ``write_stage``.
    schema = T.StructType([*STAGE_FILE_SCHEMA.fields, T.StructField("dataset", T.StringType()),
                           T.StructField("chunk", T.LongType())])
    src = spark.readStream.schema(schema).option("pathGlobFilter", "*.json").json(stage_dir)
    w = src.writeStream.foreachBatch(lambda df, bid: load_batch(df, bid, base, source)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_extract(spark: SparkSession, csv_dir: str, out: str, checkpoint: str,
                   available_now: bool = True) -> StreamingQuery:
    """Extract new posts as CSV files arrive (stateless, one pass per file)."""
    src = (spark.readStream.schema(SCH.POST_CSV).option("header", True).option("multiLine", True)
                .option("quote", '"').option("escape", '"').csv(csv_dir))
    rec = extract_posts(src.withColumn("dataset", F.col("_metadata.file_name")), "comment", "title")
    w = (rec.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def refresh_documents(docs: DataFrame, tables: L.Tables, since, tie_break=()) -> DataFrame:
    """Rebuild only documents of dishes that changed after ``since``: themselves, by their lines,
    or by an ingredient or measurement they use.  Documents of deleted dishes go, the others stay."""
    after = F.lit(since).cast("timestamp")

    def newer(df: DataFrame, column: str) -> DataFrame:
        return df.filter(F.col(column) > after) if column in df.columns else df.limit(0)

    lines = tables.dish_ingredients
    changed = newer(tables.dishes, "updated_at").select("id").unionByName(newer(lines, "created_at").select(F.col("dish_id").alias("id")))
    for dim, key in ((tables.ingredients, "ingredient_id"), (tables.measurements, "measurement_id")):
        renamed = newer(dim, "updated_at").select(F.col("id").alias(key))
        changed = changed.unionByName(lines.join(renamed, key, "left_semi").select(F.col("dish_id").alias("id")))
    changed = changed.distinct()
    docs = docs.join(tables.dishes.select("id"), "id", "left_semi")
    rebuilt = build_documents(tables.dishes.join(changed, "id", "left_semi"), tables.dish_ingredients,
                              tables.ingredients, tables.measurements, tie_break)
    return docs.join(changed, "id", "left_anti").unionByName(rebuilt.select(*docs.columns))


def document_digests(tables: L.Tables) -> DataFrame:
    """(id, lines, d1, d2): what a document is made from, as sums of hashes over its dish, lines, ingredient names and
    measurements, whatever their order."""
    def two(*cols) -> list:
        return [F.xxhash64(F.lit(k), *cols).cast("decimal(20,0)").alias(f"h{k}") for k in (1, 2)]

    i = tables.ingredients.select(F.col("id").alias("ingredient_id"), F.xxhash64(F.struct(*[
        c for c in tables.ingredients.columns if c not in ("created_at", "updated_at")])).alias("_i"))
    m = tables.measurements.select(F.col("id").alias("measurement_id"), F.xxhash64(F.struct(*[
        c for c in tables.measurements.columns if c not in ("created_at", "updated_at")])).alias("_m"))
    own = [c for c in tables.dish_ingredients.columns if c not in ("id", "created_at")]
    lines = tables.dish_ingredients.join(i, "ingredient_id", "left").join(m, "measurement_id", "left")
    lines = lines.select(F.col("dish_id").alias("id"), F.lit(1).alias("n"), *two(F.struct(*own), "_i", "_m"))
    dishes = tables.dishes.select("id", F.lit(0).alias("n"), *two(F.struct(*[c for c in tables.dishes.columns if c not in ("created_at", "updated_at")])))
    found = dishes.unionByName(lines.join(tables.dishes.select("id"), "id", "left_semi"))
    return found.groupBy("id").agg(F.sum("n").alias("lines"), F.sum("h1").alias("d1"), F.sum("h2").alias("d2"))


def refresh_changed(docs: DataFrame, before: DataFrame, tables: L.Tables, tie_break=()) -> tuple[DataFrame, DataFrame]:
    """T3 without time stamps: the documents, those rebuilt whose digest isn't that of ``before`` (lines taken away, names
    changed, new dishes), those of deleted dishes gone; and the digests for the next time."""
    now = document_digests(tables)
    same = now.join(before, ["id", "lines", "d1", "d2"], "left_semi").select("id")
    changed = now.select("id").join(same, "id", "left_anti")
    rebuilt = build_documents(tables.dishes.join(changed, "id", "left_semi"), tables.dish_ingredients.join(
        changed.select(F.col("id").alias("dish_id")), "dish_id", "left_semi"), tables.ingredients, tables.measurements, tie_break)
    return docs.join(same, "id", "left_semi").unionByName(rebuilt.select(*docs.columns)), now


def dedupe_stream(stream: DataFrame, ts: str, delay: str = "1 hour") -> DataFrame:
    """T4 inside a stream: drop repeated entries that arrive within the watermark delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["dataset", "entryNumber"])


def recent_counts(df: DataFrame, ts: str = "ts", window: str = "1 hour", watermark: str | None = "10 minutes",
                  by: tuple = ()) -> DataFrame:
    """T5: tumbling-window counts; on a stream rows later than the watermark are dropped.
    (An extension of the reference's one-off 'count in the last hour'.)"""
    d = df.withWatermark(ts, watermark) if (watermark and df.isStreaming) else df
    g = d.groupBy(F.window(ts, window).alias("w"), *by).agg(F.count(F.lit(1)).alias("count"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "count")


def stream_recent(spark: SparkSession, path: str, schema, out: str, checkpoint: str, ts: str = "ts",
                  window: str = "1 hour", watermark: str = "10 minutes") -> StreamingQuery:
    """T5 as a running query over a parquet drop directory: windows are appended as parquet to
    ``out`` once they close."""
    src = spark.readStream.schema(schema).parquet(path)
    agg = recent_counts(src, ts, window, watermark)
    return (agg.writeStream.outputMode("append").format("parquet").option("path", out)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def last_interval_counts(df: DataFrame, ts: str = "ts", interval: str = "1 hour", every: str = "15 minutes",
                         watermark: str | None = "10 minutes") -> DataFrame:
    """T5: (until, count): how many rows lie in the ``interval`` before each point ``every`` so often.  On a stream a point is
    given once, when the watermark has passed it.  Watermarks need an instant: a time without zone is read in the
    session's zone, and given back without."""
    kind = df.schema[ts].dataType
    d = df.withColumn(ts, F.col(ts).cast("timestamp"))
    d = d.withWatermark(ts, watermark) if (watermark and df.isStreaming) else d
    g = d.groupBy(F.window(ts, interval, every).alias("w")).agg(F.count(F.lit(1)).alias("count"))
    return g.select(F.col("w.end").cast(kind).alias("until"), "count")


def stream_last_interval(spark: SparkSession, path: str, schema, out: str, checkpoint: str, ts: str = "ts", interval: str = "1 hour",
                         every: str = "15 minutes", watermark: str = "10 minutes", available_now: bool = True) -> StreamingQuery:
    """T5 as a running query: the counts are appended to a table under ``out`` as their points pass."""
    src = spark.readStream.schema(schema).parquet(path)
    w = last_interval_counts(src, ts, interval, every, watermark).writeStream.outputMode("append").format("parquet")
    w = w.option("path", out).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
