"""End-to-end jobs: the reference's CSV -> staged JSON -> tables -> search documents flow as Spark jobs.

Tables live in the same layout as the streaming loader (parquet partitioned by source and batch),
so batch and streaming loads can take turns over one state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.records import extract_posts, extract_structured
from ..operators.relational import build_documents
from ..session import cut_lineage
from ..sources import readers as RD
from ..sources import staging as ST
from ..sources import status as STS
from ..streaming import incremental as INC

POST_META = {"title": "title", "user": "user", "date": "date", "num_comments": "num_comments", "n_char": "n_char"}
STRUCTURED_META = {"title": "title", "link": "link", "source": "source", "site": "site", "ner": "NER"}


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


#: Files whose names hold this are structured rows, others posts (A3).
STRUCTURED_MARKER = "structured"


def kind_of(path: str, marker: str = STRUCTURED_MARKER) -> str:
    """A3 for a path: by its file name."""
    return "structured" if marker in path.rstrip("/").rsplit("/", 1)[-1].lower() else "posts"


def extract_to_stage(spark: SparkSession, paths: Sequence[str], stage_dir: str, kind: str | None = None,
                     chunk_size: int = 1000, marker: str = STRUCTURED_MARKER, split: bool = False) -> DataFrame:
    """Read CSV files, skip entries already staged, extract records and append them to the stage.
    Each file is read as its name says (``kind`` overrides it); ``split`` reads large files of posts in parallel.  What is staged is looked up in the stage's ledger, of
    which the folders of these files alone are read.  Returns one outcome row per entry (success, or failed for malformed
    rows / records without ingredients and steps)."""
    out = None
    for k in ("posts", "structured"):
        mine = [p for p in paths if (kind or kind_of(p, marker)) == k]
        if mine:
            found = _extract_kind(spark, mine, stage_dir, k, chunk_size, split)
            out = found if out is None else out.unionByName(found)
    if out is None:
        raise ValueError("no paths")
    return out


def _ledger(spark: SparkSession, stage_dir: str) -> DataFrame | None:
    """The stage's ledger; a stage that was written without one gets it here."""
    if not _exists(spark, stage_dir):
        return None
    if not _exists(spark, f"{stage_dir}/{ST.LEDGER}"):
        ST.write_ledger(ST.read_stage(spark, stage_dir), stage_dir)
    return ST.read_ledger(spark, stage_dir)


def _extract_kind(spark: SparkSession, paths: Sequence[str], stage_dir: str, kind: str, chunk_size: int, split: bool) -> DataFrame:
    posts = RD.read_posts_csv_split if split else RD.read_posts_csv
    raw = (posts(spark, list(paths), keep_corrupt=True) if kind == "posts"
           else RD.read_structured_csv(spark, list(paths), keep_corrupt=True))
    ledger = _ledger(spark, stage_dir)
    if ledger is not None:
        # Plain file names prune the ledger; patterns and folders name no dataset.
        names = [p.rsplit("/", 1)[-1] for p in paths]
        raw = ST.skip_staged(raw, ledger, names if all(n.endswith(".csv") and "*" not in n for n in names) else None)
    rec = (extract_posts(raw, "comment", "title") if kind == "posts"
           else extract_structured(raw, "ingredients", "directions", "title"))
    empty = (F.size("dish.ingredients") == 0) & (F.size("dish.instructions") == 0)
    rec = STS.with_status(rec, ~empty, F.when(empty, F.lit("no ingredients or steps found")).otherwise(
        F.lit("malformed row")))
    rec = RD.with_chunk(rec, chunk_size)
    rec = cut_lineage(rec)       # extracted once: the stage write and the outcome report read it
    good = rec.filter(F.col("status") == "success")
    stage = ST.to_stage(good, POST_META if kind == "posts" else STRUCTURED_META, chunk_size=chunk_size)
    ST.write_stage(stage, stage_dir)
    ST.write_ledger(stage, stage_dir)
    return rec.select("dataset", "entry_number", "chunk", "status", "error", F.current_timestamp().alias("ts"))


def load_stage_dir(spark: SparkSession, stage_dir: str, tables_dir: str) -> DataFrame:
    """Load every staged entry not loaded yet into the four tables (the batch form of T1).
    Returns the outcomes of this load."""
    last = INC.read_commits(spark, tables_dir).where("source = 'batch'").agg(F.max("batch")).first()[0]
    batch_id = 0 if last is None else int(last) + 1
    INC.load_batch(ST.read_stage(spark, stage_dir), batch_id, tables_dir)
    return spark.read.schema(INC.OUTCOMES).parquet(f"{tables_dir}/outcomes/source=batch/batch={batch_id}")


def export_documents(spark: SparkSession, tables_dir: str, out: str) -> DataFrame:
    """Build the nested search documents from the current tables and write them."""
    t = INC.read_tables(spark, tables_dir)
    docs = build_documents(t.dishes, t.dish_ingredients, t.ingredients, t.measurements, ("ingredient_id",))
    ST.write_documents(docs, out)
    return spark.read.parquet(out)


def stream_extract_to_stage(spark: SparkSession, csv_dir: str, stage_dir: str, checkpoint: str, available_now: bool = True,
                            files_per_batch: int = 100, split: bool = False) -> StreamingQuery:
    """CSV files that arrive become staged JSON, which :func:`mise.streaming.incremental.stream_stage` loads.

    The stream tells which files are new (their names alone are read, ``files_per_batch`` at a time), and each batch is
    an :func:`extract_to_stage` of them: entry numbers are places in the file, so they are the same after a restart, and
    the ledger keeps what a batch that is replayed had already staged from being staged again."""
    files = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
                  .option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", files_per_batch).load(csv_dir).select("path"))

    def extract(batch: DataFrame, _: int) -> None:
        paths = sorted(r["path"] for r in batch.collect())
        if paths:
            extract_to_stage(spark, paths, stage_dir, split=split)

    w = files.writeStream.foreachBatch(extract).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
