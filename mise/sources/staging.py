"""Staging extracted records as JSON and reading them back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as SCH
from .readers import entry_from_file_name

STAGE_FILE_SCHEMA = T.StructType([f for f in SCH.STAGED.fields if f.name != "dataset"])


def to_stage(df: DataFrame, metadata: dict[str, str], record: str = "dish", entry: str = "entry_number",
             dataset: str = "dataset", chunk_size: int = 1000) -> DataFrame:
    """Shape extracted rows as staged records {dataset, entryNumber, metadata{...}, recipeData, chunk};
    ``metadata`` maps metadata fields to source columns (missing fields are NULL)."""
    meta = F.struct(*[(F.col(metadata[m]).cast("string") if m in metadata else F.lit(None).cast("string")).alias(m)
                      for m in SCH.METADATA.fieldNames()])
    return df.select(F.col(dataset).alias("dataset"), F.col(entry).alias("entryNumber"), meta.alias("metadata"),
                     F.col(record).alias("recipeData"),
                     F.floor((F.col(entry) - 1) / chunk_size).cast("bigint").alias("chunk"))


def write_stage(stage: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines partitioned by dataset and chunk (not one file per entry).  Re-running a
    chunk with ``partitionOverwriteMode=dynamic`` replaces only that chunk."""
    (stage.write.mode(mode).option("partitionOverwriteMode", "dynamic")
          .partitionBy("dataset", "chunk").json(path))


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """Staged records; only ``*.json`` files are read, partition columns are recovered."""
    schema = T.StructType([*STAGE_FILE_SCHEMA.fields, T.StructField("dataset", T.StringType()),
                           T.StructField("chunk", T.LongType())])
    return (spark.read.schema(schema)
                 .option("pathGlobFilter", "*.json").option("basePath", path).json(path))


LEDGER = "_staged"   # its name keeps it out of the stage's own files
LEDGER_SCHEMA = "entryNumber long, dataset string, chunk long"


def write_ledger(stage: DataFrame, path: str) -> None:
    """The keys of a stage batch, partitioned as the stage is: what says which entries are staged without reading them.
    Written after the batch; keys that are there twice do no harm."""
    stage.select("entryNumber", "dataset", "chunk").write.mode("append").partitionBy("dataset", "chunk").parquet(f"{path}/{LEDGER}")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(entryNumber, dataset, chunk) of what is staged under ``path``."""
    return spark.read.schema(LEDGER_SCHEMA).option("basePath", f"{path}/{LEDGER}").parquet(f"{path}/{LEDGER}")


def skip_staged(new: DataFrame, ledger: DataFrame, datasets: Sequence[str] | None = None, lo: int | None = None,
                hi: int | None = None, chunk_size: int = 1000) -> DataFrame:
    """A8 from the ledger: entries that aren't staged yet.  Named datasets and an entry range prune its folders."""
    if datasets is not None:
        ledger = ledger.where(F.col("dataset").isin(list(datasets)))
    if lo is not None and hi is not None:
        ledger = ledger.where(F.col("chunk").between((lo - 1) // chunk_size, (hi - 1) // chunk_size))
    return skip_existing(new, ledger)


def read_entry_files(spark: SparkSession, path: str) -> DataFrame:
    """Staged files written one per entry (``..._entry_<n>.json``): entry number from the name."""
    df = spark.read.schema(STAGE_FILE_SCHEMA).option("pathGlobFilter", "*.json").json(path)
    return df.withColumn("entry_from_name", entry_from_file_name(F.col("_metadata.file_name")))


def skip_existing(new: DataFrame, staged: DataFrame, keys=("dataset", "entry_number"),
                  staged_keys=("dataset", "entryNumber")) -> DataFrame:
    """Entries not staged yet (anti join on the entry key)."""
    s = staged.select(*[F.col(b).alias(a) for a, b in zip(keys, staged_keys)])
    return new.join(s, list(keys), "left_anti")


def staged_entries(staged: DataFrame, entry: str = "entryNumber") -> DataFrame:
    """Per dataset: count, first and last entry."""
    return staged.groupBy("dataset").agg(F.count(F.lit(1)).alias("staged"), F.min(entry).alias("first_entry"),
                                         F.max(entry).alias("last_entry"))


#: Numbers of a range are made in blocks of this many.
RANGE_BLOCK = 10_000


def missing_entries(staged: DataFrame, lo: int, hi: int | None = None, entry: str = "entryNumber") -> DataFrame:
    """(dataset, entry_number) for each dataset's numbers from ``lo`` to ``hi`` (by default its
    own last entry) without a staged record."""
    last = F.lit(hi).cast("bigint") if hi is not None else F.max(F.col(entry).cast("bigint"))
    ends = staged.groupBy("dataset").agg(last.alias("hi")).where(F.col("hi") >= lo)
    step = F.lit(RANGE_BLOCK).cast("bigint")
    blocks = ends.select("dataset", "hi", F.explode(F.sequence(F.lit(lo).cast("bigint"), F.col("hi"), step)).alias("b"))
    # Blocks are spread, so that one dataset's numbers aren't made in one task.
    blocks = blocks.repartition("dataset", "b")
    numbers = blocks.select("dataset", F.explode(F.sequence(F.col("b"), F.least(F.col("b") + step - 1, F.col("hi")))).alias("entry_number"))
    have = staged.select("dataset", F.col(entry).cast("bigint").alias("entry_number"))
    return numbers.join(have, ["dataset", "entry_number"], "left_anti")


def stage_range(staged: DataFrame, lo: int, hi: int, entry: str = "entryNumber", chunk_size: int = 1000) -> DataFrame:
    """A10: staged records with ``lo <= entry <= hi``.  Where the stage is partitioned by chunk
    (of ``chunk_size`` entries), only the chunks of that range are read."""
    if "chunk" in staged.columns:
        staged = staged.filter(F.col("chunk").between((lo - 1) // chunk_size, (hi - 1) // chunk_size))
    return staged.filter(F.col(entry).between(lo, hi))


def write_documents(docs: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Export search documents, replacing the previous export."""
    docs.write.mode("overwrite").format(fmt).save(path)
