"""Helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Words of the pipeline's contracts: runs without space, tab, line feed, vertical tab, form feed, return.
BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column used several times inside a lambda function would be computed anew for each
    element; the variable of a one-element ``transform`` is bound to its value instead.
    """
    return F.transform(F.array(value), body).getItem(0)


def whole_text(column: str | Column = "text") -> Column:
    """The text, null as the empty string."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


#: The characters of BLANK besides the space.
OTHER_BLANKS = r"[\x09-\x0D]"


def text_words(text: Column) -> Column:
    """The words of a text as an array.  (Spark splits at a plain character faster than at a pattern.)"""
    return F.filter(F.split(F.regexp_replace(text, OTHER_BLANKS, " "), " ", -1), lambda w: w != "")


#: Folders of tables that this process wrote for its jobs, by application.
_FOLDERS: dict[str, list[str]] = {}


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder, removed by :func:`clear_scratch`."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Removes the tables that operators wrote in this session.  Results are read from them: call it after those that are
    needed were written.  A driver that ends normally does it by itself."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in _FOLDERS.pop(spark.sparkContext.applicationId, []):
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


@atexit.register
def _clear_at_exit() -> None:
    # The virtual machine may be gone already; its folders are then the cluster's to clear.
    with contextlib.suppress(Py4JError, ConnectionError):
        spark = SparkSession.getActiveSession()
        if spark is not None and spark.sparkContext._jsc is not None:
            clear_scratch(spark)


class Scratch:
    """Tables written to the shared checkpoint folder, which cut lineage: a lost executor costs no
    more than the work since the last one.  Unlike a checkpoint, what is read back is known by its
    real size, where estimates would be multiplied from join to join.  Tables that nothing will
    read again can be dropped."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._folder = own_folder(spark, "scratch")
        self._count = 0

    def table(self, df: DataFrame) -> DataFrame:
        path = f"{self._folder}/{self._count}"
        self._count += 1
        df.write.parquet(path)
        out = self._spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm, conf = self._spark._jvm, self._spark._jsc.hadoopConfiguration()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            path.getFileSystem(conf).delete(path, True)


def _prefixes(values: Column, combine: Callable[[Column, Column], Column], start: int) -> Column:
    """For an array of integers, ``combine`` over the elements before each one."""
    block, first = F.lit(SUM_BLOCK), F.lit(start)

    def over(xs: Column) -> Column:
        return F.aggregate(xs, first, combine)

    def of(xs: Column) -> Column:
        indexes = F.sequence(F.lit(0), F.size(xs) - 1)
        blocks = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / block).cast("int"))
        return let(F.transform(blocks, lambda b: over(F.slice(xs, b * block + 1, block))), lambda parts: let(
            F.transform(blocks, lambda b: over(F.slice(parts, F.lit(1), b))), lambda before: F.transform(indexes, lambda i: combine(
                before[F.floor(i / block).cast("int")], over(F.slice(xs, i - i % block + 1, i % block))))))

    return let(values, lambda xs: F.when(F.size(xs) > 0, of(xs)).otherwise(F.array().cast("array<int>")))


def running_max(values: Column) -> Column:
    """For an array of integers of 0 or more, the greatest element before each one, -1 if there is none."""
    return _prefixes(values, lambda a, x: F.greatest(a, x), -1)


#: Lengths are summed in blocks of this many, so that offsets cost about the same for each element.
SUM_BLOCK = 256


def running_sums(lengths: Column) -> Column:
    """For an array of integers, the sum of the elements before each one (exclusive prefix sums)."""
    block = F.lit(SUM_BLOCK)

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0), lambda a, x: a + x)

    def of(xs: Column) -> Column:
        indexes = F.sequence(F.lit(0), F.size(xs) - 1)
        blocks = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / block).cast("int"))
        return let(
            F.transform(blocks, lambda b: total(F.slice(xs, b * block + 1, block))),
            lambda sums: let(
                F.transform(blocks, lambda b: total(F.slice(sums, F.lit(1), b))),
                lambda before: F.transform(indexes, lambda i: before[F.floor(i / block).cast("int")]
                                           + total(F.slice(xs, i - i % block + 1, i % block)))))

    return let(lengths, lambda xs: F.when(F.size(xs) > 0, of(xs)).otherwise(F.array().cast("array<int>")))


def without_spans(text: Column, spans: Column, mask: str = "") -> Column:
    """The text with ascending, disjoint spans (structs of s and e, code points) replaced by ``mask``."""
    def end_before(xs: Column, i: Column) -> Column:
        return F.when(i > 0, xs[F.greatest(i - 1, F.lit(0))]["e"]).otherwise(0)

    def of(xs: Column) -> Column:
        pieces = F.transform(xs, lambda x, i: F.concat(
            text.substr(end_before(xs, i) + 1, x["s"] - end_before(xs, i)), F.lit(mask)))
        return F.concat(F.array_join(pieces, ""), text.substr(F.element_at(xs, -1)["e"] + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(let(spans, of))


def row_bytes(batch: pa.RecordBatch) -> np.ndarray:
    """The bytes of each row's texts (and eight for each other value)."""
    total = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type):
            total += np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
        else:
            total += 8
    return total


def arrow_rows(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches cut where the bytes of their rows add up to ``most_bytes``, so that texts of any mixture of
    lengths make slices of about equal bytes.  A single row is never cut here: one that is larger is a slice of its own."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(row_bytes(batch))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            yield batch.slice(at, upto - at)
            at = upto


def portions(texts: list[str], most_chars: int) -> Iterator[list[str]]:
    """Consecutive texts of about ``most_chars`` characters together, at least one each."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > most_chars:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part
