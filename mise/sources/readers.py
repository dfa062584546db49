"""Reading raw files and numbering entries.

Entry numbers are the 1-based position of a row in its file.  They are computed once, at
ingest, without a window over the whole file: rows are counted per file block, the blocks of a
file get running offsets (a small aggregate), and a row's position inside its block comes from
``monotonically_increasing_id`` (which increases with row order inside a task).  A file that
holds a third of all rows therefore costs one small aggregate per block, not one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as SCH
from ..session import cut_lineage


def _with_file(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_name").alias("_name"),
                     F.col("_metadata.file_block_start").alias("_block"))


def number_entries(df: DataFrame, out: str = "entry_number", dataset: str = "dataset") -> DataFrame:
    """A4: ``dataset`` = file name, ``entry_number`` = 1-based row position in the file
    (positions are per file path, so equal names in different folders are numbered apart).

    ``df`` must come straight from a file read (it uses the ``_metadata`` column)."""
    d = _with_file(df).withColumn("_mono", F.monotonically_increasing_id())
    blocks = d.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mono").alias("_m0"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (d.join(blocks, ["_file", "_block"])
             .withColumn(out, (F.col("_off") + F.col("_mono") - F.col("_m0") + 1).cast("bigint"))
             .withColumnRenamed("_name", dataset)
             .drop("_file", "_block", "_mono", "_n", "_m0", "_off"))


CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_posts_csv(spark: SparkSession, path: str | Sequence[str], number: bool = True,
                   keep_corrupt: bool = False) -> DataFrame:
    """A1: quoted CSV whose cells hold newlines.  ``multiLine`` files are not split: a large one is read in
    parallel by :func:`read_posts_csv_split`.
    ``keep_corrupt`` keeps malformed rows, with their raw text in ``_corrupt_record`` (A12)."""
    schema = _with_corrupt(SCH.POST_CSV) if keep_corrupt else SCH.POST_CSV
    df = (spark.read.schema(schema).option("header", True).option("multiLine", True)
               .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    return number_entries(df) if number else df


# ------------------------------------------------------------------- quoted cells over file splits
_SPLIT = "_file string, _block long, quotes int, starts_even long, starts_odd long"
_PIECE = "_file string, _name string, _block long, number long, kind string, text string"


def _split_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each file split: whether it holds an odd number of quotes, and how many records start in it if it begins
    outside a quoted cell, and if it begins inside one."""
    found: dict[tuple, list[int]] = {}
    for batch in batches:
        for line, file, block in zip(*(batch.column(c).to_pylist() for c in ("value", "_file", "_block"))):
            state = found.setdefault((file, block), [0, 0, 0])
            line = line.rstrip("\r")
            if line:
                state[1 + state[0]] += 1
            state[0] ^= line.count('"') & 1
    if found:
        keys, values = zip(*found.items())
        files, blocks = zip(*keys)
        yield pa.RecordBatch.from_arrays([pa.array(files), pa.array(blocks, pa.int64()), *(pa.array(v, t) for v, t in zip(
            zip(*values), (pa.int32(), pa.int64(), pa.int64())))], ["_file", "_block", "quotes", "starts_even", "starts_odd"])


def _split_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each split, and the pieces at its ends: ``tail`` starts a record that a later split goes on with,
    ``middle`` and ``head`` go on with one."""
    names = ["_file", "_name", "_block", "number", "kind", "text"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    at, name, inside, first, number, lines, out = None, None, False, False, 0, [], []

    def close(kind: str) -> None:
        out.append((*at[:1], name, at[1], number, kind, "\n".join(lines)))
        lines.clear()

    def taken() -> Iterator[pa.RecordBatch]:
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out.clear()

    for batch in batches:
        for line, file, called, block, odd, before in zip(*(batch.column(c).to_pylist() for c in ("value", "_file", "_name", "_block", "odd", "before"))):
            if (file, block) != at:
                if lines:
                    close("middle" if first else "tail")
                at, name, inside, first, number = (file, block), called, odd == 1, odd == 1, before
            line = line.rstrip("\r")
            if not lines and not inside:
                if not line:
                    continue
                number += 1
            lines.append(line)
            inside ^= bool(line.count('"') & 1)
            if not inside:
                close("head" if first else "record")
                first = False
        yield from taken()
    if lines:
        close("middle" if first else "tail")
    yield from taken()


def read_posts_csv_split(spark: SparkSession, path: str | Sequence[str], keep_corrupt: bool = False) -> DataFrame:
    """A1 with files read in parallel: the rows and entry numbers of :func:`read_posts_csv`, for files whose quotes are
    balanced as CSV writers leave them (a quote within a cell doubled, such a cell quoted).

    Files are read as lines, split by split.  A first pass counts the quotes and the possible record starts of each split;
    sums over the splits before it say whether it begins inside a quoted cell and how many records start before it.  A
    second pass puts lines together to records; what crosses the ends of splits is joined by file.  Two rows at most come
    from the ends of a split, so nothing but records is ever shuffled whole."""
    schema = _with_corrupt(SCH.POST_CSV) if keep_corrupt else SCH.POST_CSV
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_name").alias("_name"),
                         F.col("_metadata.file_block_start").alias("_block"))
    counts = lines.select("value", "_file", "_block").mapInArrow(_split_counts, _SPLIT)
    # One row for each split of a file.
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("odd", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int"))
    counts = counts.withColumn("starts", F.when(F.col("odd") == 0, F.col("starts_even")).otherwise(F.col("starts_odd")))
    counts = counts.select("_file", "_block", "odd", F.coalesce(F.sum("starts").over(before), F.lit(0)).cast("long").alias("before"))
    # Sent to all tasks, a row for each split: a shuffle would lose the order of the lines.
    pieces = cut_lineage(lines.join(F.broadcast(counts), ["_file", "_block"]).mapInArrow(_split_records, _PIECE))
    ends = pieces.where("kind != 'record'")
    by_place = Window.partitionBy("_file").orderBy("_block", F.when(F.col("kind") == "tail", 1).otherwise(0))
    ends = ends.withColumn("_n", F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(by_place))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("_block", F.when(F.col("kind") == "tail", 1).otherwise(0).alias("k"), "text"))), lambda x: x["text"])
    joined = ends.groupBy("_file", "_name", "_n").agg(F.max(F.when(F.col("kind") == "tail", F.col("number"))).alias("number"),
                                                      F.array_join(parts, "\n").alias("text"))
    records = pieces.where("kind = 'record'").select("_name", "number", "text").unionByName(joined.select("_name", "number", "text"))
    # The first record of a file is its header.
    records = records.where("number > 1").select(F.col("_name").alias("dataset"), (F.col("number") - 1).alias("entry_number"), F.from_csv(
        "text", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
        {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    return records.select("r.*", "entry_number", "dataset")


def read_structured_csv(spark: SparkSession, path: str | Sequence[str], multiline: bool = False,
                        number: bool = True, keep_corrupt: bool = False) -> DataFrame:
    """A2: structured rows; JSON-array cells stay strings until :func:`decode_json_array`.
    Without embedded newlines the file is read split (in parallel)."""
    schema = _with_corrupt(SCH.STRUCTURED_CSV) if keep_corrupt else SCH.STRUCTURED_CSV
    df = (spark.read.schema(schema).option("header", True).option("multiLine", multiline)
               .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    return number_entries(df) if number else df


def read_many(spark: SparkSession, paths: Sequence[str], kind: str = "posts") -> DataFrame:
    """Several files of one format as one dataset, keyed by (dataset, entry_number)."""
    reader = read_posts_csv if kind == "posts" else read_structured_csv
    return reader(spark, list(paths))


def route_by_source(df: DataFrame, marker: str, dataset: str = "dataset") -> DataFrame:
    """A3: ``format`` = 'structured' when the file name contains the marker, else 'posts'."""
    return df.withColumn("format", F.when(F.lower(F.col(dataset)).contains(marker), F.lit("structured"))
                                    .otherwise(F.lit("posts")))


def select_entries(df: DataFrame, start: int, end: int, entry: str = "entry_number") -> DataFrame:
    """A4: entries ``start``..``end`` inclusive."""
    return df.filter(F.col(entry).between(start, end))


def chunk_col(entry: Column | str, size: int) -> Column:
    e = F.col(entry) if isinstance(entry, str) else entry
    return F.floor((e - 1) / F.lit(size)).cast("bigint")


def with_chunk(df: DataFrame, size: int = 1000, entry: str = "entry_number") -> DataFrame:
    """A5: chunk id of every entry (also a good partition column for staging)."""
    return df.withColumn("chunk", chunk_col(entry, size))


def from_chunk(df: DataFrame, k: int, size: int = 1000, entry: str = "entry_number") -> DataFrame:
    """A5: resume at chunk ``k`` (a filter that prunes partitions when chunk is a partition column)."""
    d = df if "chunk" in df.columns else with_chunk(df, size, entry)
    return d.filter(F.col("chunk") >= k)


def entry_from_file_name(file_name: Column | str) -> Column:
    """A10: entry number encoded as ``..._entry_<n>.json`` in a file name."""
    c = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.nullif(F.regexp_extract(c, r"entry_(\d+)\.json$", 1), F.lit("")).cast("bigint")
