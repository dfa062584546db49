"""Packing of documents into sequences of bounded length, balanced by cost.

A piece of n tokens costs LINEAR n + QUADRATIC n^2, as the layers and their attention do.  Within
each partition, documents come in groups of about GROUP_TOKENS.  Whole sequences are cut off long
documents first: they are full by themselves.  What is left of each document, in descending order
of cost, goes to the sequence of lowest cost that has room for all of it; if none has, the emptiest
one is filled and the rest goes on.  A group gets as many sequences as its tokens need, so at most
one sequence's worth of padding is left in it.

Memory is bounded by a group and the longest document.  Nothing is shuffled, and a task run again
gives the same rows: sequence ids are made of the partition's number and a count within it.

Defined results: a null text is empty, and its document is its end id alone; repeated rows are
packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows
from .tokens import BATCH_BYTES, encoder

LINEAR, QUADRATIC = 1.0, 1.0 / 1024
#: Tokens packed together.
GROUP_TOKENS = 1_000_000
#: Sequence ids are partition << PARTITION_BITS, plus a count.
PARTITION_BITS = 36

PIECES = [T.StructField(n, T.LongType()) for n in (
    "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]


def cost(n):
    return LINEAR * n + QUADRATIC * n * n


def assign(lengths: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of these lengths."""
    whole, left = lengths // capacity, lengths % capacity
    pieces = [(d, k * capacity, capacity, 0, 0) for d in range(len(lengths)) for k in range(whole[d])]
    pieces = [(d, s, n, q, o) for q, (d, s, n, _, o) in enumerate(pieces)]
    first = len(pieces)
    count = -(-int(left.sum()) // capacity)
    costs, room = np.zeros(count), np.full(count, capacity)
    order = np.lexsort((np.arange(len(left)), -left)).tolist()
    todo = [(int(left[d]), d, int(whole[d] * capacity)) for d in order if left[d]]
    for n, d, start in todo:
        while n:
            fits = np.where(room >= n, costs, np.inf)
            q = int(fits.argmin())
            if room[q] < n:
                q = int(room.argmax())
            m = min(n, int(room[q]))
            pieces.append((d, start, m, first + q, capacity - int(room[q])))
            costs[q] += cost(m)
            room[q] -= m
            n, start = n - m, start + m
    return pieces


def pack(docs: DataFrame, path: str, capacity: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
         group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: id, start and length in the document's tokens (its text's, then ``end_id``),
    CRC-32 of the piece's ids, the document's tokens, and the sequence and offset it lies at."""
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, used = encoder(path), 0
        ids: list[pa.Array] = []
        tokens: list[bytes] = []
        size = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal used, size
            pieces = assign(np.array([len(x) // 4 for x in tokens], np.int64), capacity)
            base = (TaskContext.get().partitionId() << PARTITION_BITS) + used
            used += 1 + max((p[3] for p in pieces), default=-1)
            rows = [(s, n, zlib.crc32(tokens[d][4 * s:4 * (s + n)]), len(tokens[d]) // 4, base + q, o) for d, s, n, q, o in pieces]
            keys = pa.concat_arrays(ids).take(pa.array([p[0] for p in pieces], pa.int64()))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([keys, *columns], names=["doc_id", *[f.name for f in PIECES]])
            ids.clear()
            tokens.clear()
            size = 0

        for batch in arrow_rows(batches, BATCH_BYTES):
            found = [x + end for x in enc.ids(batch.column(1).to_pylist())]
            ids.append(batch.column(0))
            tokens += found
            size += sum(map(len, found)) // 4
            if size >= group_tokens:
                yield from packed()
        if tokens:
            yield from packed()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], *PIECES]))
