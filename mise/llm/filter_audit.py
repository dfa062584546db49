"""Filter interaction audit: what each filter removes in every order, from one Gray-code walk over all filter subsets.

Documents are first reduced to cells: how many there are for each part and each mask of failed
filters.  The walk visits the 2^n subsets of filters in Gray-code order, so that each step toggles
one filter.  It keeps, for every mask cell, a counter of the active filters that the cell fails, and
for every part the running number of survivors (those in cells whose counter is 0); only cells whose
counter leaves or reaches 0 change it.  The 2^n states are stored.  Any figure of any order is then
a difference of two of them: after the filters of set S, filter f removes state[S] - state[S + f].

The counters depend on the mask alone, so one walk serves a whole batch of parts as numpy columns.
A part is one row of at most 2^n cells after the aggregation, however many documents it has.

Defined results: a null text is empty; a null part and the empty string are one part, written as the
empty string; repeated rows count each; a row without id is no copy of another, nor another of it;
labels that name an id several times count as 1 if any row says 1, documents without a label as 0; a
condition that is null isn't a failure; an empty table gives an empty result; other columns of the
tables are never read, whatever their names.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, let, text_words, whole_text

#: 2^n states and n! orders of n steps are kept for a part.
MOST_FILTERS = 6
#: Rows of one Arrow batch that a task returns.
BATCH_ROWS = 60_000
#: What is counted in a cell: documents, those labelled as good ones, those labelled as toxic.
COUNTS = ("n", "good", "toxic")

# Fixed values of the filters.
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 2
SIGNS = "[#$%&*|]"


# ------------------------------------------------------------------------------ masks and cells
def text_failures(docs: DataFrame, id_col: str, part_col: str, text_col: str) -> DataFrame:
    """Columns doc_id, part, digest of the text, and the conditions A to D on one text: few words, few
    different words, many capitals, signs."""
    text = whole_text(text_col)
    sizes = let(text_words(text), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                       F.sha2(text, 256).alias("digest"), sizes.alias("w"),
                       F.length(F.regexp_replace(text, "[^A-Z]+", "")).alias("upper"), F.length(text).alias("size"),
                       text.rlike(SIGNS).alias("signs"))
    return rows.select("doc_id", "part", "digest", (F.col("w.n") < MIN_WORDS).alias("A"),
                       (100 * F.col("w.d") < MIN_DISTINCT_PERCENT * F.col("w.n")).alias("B"),
                       (100 * F.col("upper") > MAX_UPPER_PERCENT * F.col("size")).alias("C"), F.col("signs").alias("D"))


def mask_of(conditions: Sequence[Column]) -> Column:
    """Bit i is set if condition i is true."""
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions)]
    return sum(bits[1:], bits[0])


def cells(failures: DataFrame, filters: Sequence[str], copies: str | None, labels: DataFrame | None = None,
          id_col: str = "doc_id") -> DataFrame:
    """One row per part and mask of failed filters: part, mask, and how many documents (n), good and toxic ones.

    ``failures`` has doc_id, part and a condition for each of ``filters``; the one named ``copies``, if any,
    is made here: the document's ``digest`` is that of a document with a smaller id.
    """
    if not 0 < len(filters) <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters, not {len(filters)}")
    single = [F.lit(False) if f == copies else F.col(f) for f in filters]
    keys = ["doc_id", "part", "mask", *(["digest"] if copies else [])]
    # Repeated rows are one from here on, so that an id on many rows is no hot key of the joins.
    rows = failures.withColumn("mask", mask_of(single)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if copies:
        rows = Scratch(failures.sparkSession).table(rows)
        firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
        # Joined by digest and id, which few rows share, and not by the digest of perhaps a third of all texts.
        bit = 1 << list(filters).index(copies)
        later = F.col("first").isNull() & F.col("doc_id").isNotNull()
        rows = rows.join(firsts, ["digest", "doc_id"], "left").withColumn(
            "mask", F.col("mask") + F.when(later, F.lit(bit)).otherwise(F.lit(0)))
    good, toxic = F.lit(False), F.lit(False)
    if labels is not None:
        flags = labels.groupBy(F.col(id_col).alias("doc_id")).agg(
            F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("bad"))
        rows = rows.join(flags, "doc_id", "left")
        good, toxic = F.col("good"), F.col("bad")
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.when(good, F.col("n")).otherwise(0)).alias("good"),
                                            F.sum(F.when(toxic, F.col("n")).otherwise(0)).alias("toxic"))


# -------------------------------------------------------------------------------------- the walk
def gray_walk(counts: np.ndarray) -> np.ndarray:
    """Survivors of every subset of filters: from counts [part, mask, what] to states [part, subset, what]."""
    n_masks = counts.shape[1]
    masks = np.arange(n_masks)
    failing = np.zeros(n_masks, dtype=np.int64)  # active filters that a cell fails
    survivors = counts.sum(axis=1)
    states = np.empty_like(counts)
    states[:, 0] = survivors
    active = 0
    for step in range(1, n_masks):
        bit = step & -step  # the filter that the Gray code toggles
        active ^= bit
        has = (masks & bit) != 0
        if active & bit:
            leaving = has & (failing == 0)
            failing[has] += 1
            survivors = survivors - counts[:, leaving].sum(axis=1)
        else:
            failing[has] -= 1
            survivors = survivors + counts[:, has & (failing == 0)].sum(axis=1)
        states[:, active] = survivors
    return states


def filter_states(found: DataFrame, n_filters: int) -> DataFrame:
    """One row per part: part, and for each of COUNTS the array of survivors by subset of filters (bit i: filter i)."""
    n_masks = 1 << n_filters

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("cells")
            flat, sizes = lists.flatten(), np.diff(lists.offsets.to_numpy())
            counts = np.zeros((batch.num_rows, n_masks, len(COUNTS)), dtype=np.int64)
            row, mask = np.repeat(np.arange(batch.num_rows), sizes), flat.field("mask").to_numpy()
            for k, what in enumerate(COUNTS):
                counts[row, mask, k] = flat.field(what).to_numpy()
            states = gray_walk(counts)
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * n_masks
            columns = [pa.ListArray.from_arrays(offsets, np.ascontiguousarray(states[:, :, k]).ravel()) for k in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([batch.column("part"), *columns], ["part", *COUNTS])

    # At most 2^n cells in a group.
    rows = found.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))
    return rows.mapInArrow(walk, "part string, " + ", ".join(f"{c} array<bigint>" for c in COUNTS))


# --------------------------------------------------------------------------------------- figures
def all_orders(filters: Sequence[str]) -> list[tuple[int, ...]]:
    return list(itertools.permutations(range(len(filters))))


def step_figures(states: DataFrame, filters: Sequence[str], orders: Sequence[Sequence[int]] | None = None) -> DataFrame:
    """Differences of states: one row per part, order and step, with the figures of the step's filter.

    part, filter_order (names joined), step (from 1), filter, and long counts of documents: kept after
    the step, removed in it, redundant (fail the filter, but were removed earlier), unique_fails (fail
    this filter only), good_lost, toxic_lost (removed here and labelled so) and shapley: what the filter
    removes, summed over all orders of all filters.
    """
    n = len(filters)
    full = (1 << n) - 1
    orders = [tuple(o) for o in (all_orders(filters) if orders is None else orders)]
    before, after, which, names, numbers = [], [], [], [], []
    for order in orders:
        active = 0
        for step, f in enumerate(order, 1):
            before.append(active)
            active |= 1 << f
            after.append(active)
            which.append(f)
            numbers.append(step)
            names.append("".join(filters[i] for i in order))
    bits = 1 << np.arange(n)
    # In how many orders a subset is exactly what stands before the filter.
    weights = np.array([math.factorial(s.bit_count()) * math.factorial(max(n - 1 - s.bit_count(), 0)) for s in range(full + 1)])
    names, letters = np.array(names, dtype=object), np.array(list(filters), dtype=object)
    before, after, which, numbers = np.array(before), np.array(after), np.array(which), np.array(numbers, dtype=np.int32)
    at_once = max(1, BATCH_ROWS // len(names))

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, at_once):
                part = batch.slice(at, at_once)
                rows = part.num_rows
                kept, good, toxic = (part.column(c).flatten().to_numpy().reshape(rows, full + 1) for c in COUNTS)
                fails = kept[:, :1] - kept[:, bits]
                unique = kept[:, full ^ bits] - kept[:, [full]]
                shapley = np.empty((rows, n), dtype=np.int64)
                for f in range(n):
                    without = np.array([s for s in range(full + 1) if not s & bits[f]])
                    shapley[:, f] = ((kept[:, without] - kept[:, without | bits[f]]) * weights[without]).sum(axis=1)
                removed = kept[:, before] - kept[:, after]
                numeric = [kept[:, after], removed, fails[:, which] - removed, unique[:, which],
                           good[:, before] - good[:, after], toxic[:, before] - toxic[:, after], shapley[:, which]]
                spread = pa.array(np.repeat(np.arange(rows), len(names)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("part").take(spread), pa.array(np.tile(names, rows), pa.string()), pa.array(np.tile(numbers, rows)),
                     pa.array(np.tile(letters[which], rows), pa.string()), *(pa.array(x.ravel()) for x in numeric)], COLUMNS)

    return states.mapInArrow(figures, "part string, filter_order string, step int, filter string, "
                             + ", ".join(f"{c} bigint" for c in FIGURES))


FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
COLUMNS = ["part", "filter_order", "step", "filter", *FIGURES]
FILTERS = ("A", "B", "C", "D", "E")


def audit(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", part_col: str = "source",
          text_col: str = "text") -> DataFrame:
    """The five filters over the documents: ``step_figures`` for each part and all orders."""
    failures = text_failures(docs, id_col, part_col, text_col)
    found = cells(failures, FILTERS, "E", labels, id_col)
    states = Scratch(docs.sparkSession).table(filter_states(found, len(FILTERS)))
    return step_figures(states, FILTERS)


def audit_conditions(docs: DataFrame, conditions: Mapping[str, Column], id_col: str = "doc_id", part_col: str = "source",
                     labels: DataFrame | None = None) -> DataFrame:
    """The same for filters of one's own: a condition, true for documents that fail, by name."""
    failures = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                           *[c.alias(name) for name, c in conditions.items()])
    names = list(conditions)
    return step_figures(filter_states(cells(failures, names, None, labels, id_col), len(names)), names)
