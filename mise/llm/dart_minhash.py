"""Near-duplicate documents by DartMinHash signatures, banded joins and exact verification.

A document is a weighted set of its five-word shingles (the words, in lower case, between white
space; a shorter text is one shingle).  DartMinHash throws darts at the plane of weight and time:
the plane over each element is tiled into rectangles of area one, each holding a hashed, Poisson
number of darts at hashed places.  A dart counts if it lies below the element's weight and before a
time that makes about SIZE ln SIZE + 3 SIZE of them count in all; each lands at one of SIZE
coordinates, where the earliest wins.  If a coordinate stays empty, the time is doubled.  Two
documents agree at a coordinate with the probability of their weighted Jaccard similarity.  All
this takes time for the elements plus a constant for the signature, not for their product.

Coordinates are joined to bands.  Documents with a band in common are candidates; a candidate pair
is linked if its exact similarity reaches the threshold; classes are the components of the links.

Copies (the same words) are one node from the start.  Comparing all candidates of a large bucket is
not needed to find its classes: in rounds, nodes are compared to a few leaders of their buckets,
which joins most near copies.  Then what is left in several classes is compared completely: in
buckets of up to SMALL nodes pair by pair, and in larger ones by blocks of nodes.  A block meets
another in one task, which returns the links it finds and not the pairs; blocks within the largest
class of a group of large buckets don't meet.  So no candidate pair of different classes goes
unverified, no link is lost, and no row is written for each pair of a group.

Defined results: a null text is empty; all texts without words are copies of each other; the class
id is the least document id of the class (null if it has none but null); repeated rows get a row
each; an empty table gives an empty result.  Filtering keeps one row of each class, the one with
the class id, and carries other columns through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, arrow_rows, whole_text
from .components import connected_components

BATCH_BYTES = 2_000_000
#: Words whose hash a worker remembers at most.
MOST_WORDS = 300_000


@dataclass(frozen=True)
class Settings:
    """``weights``: "set" (each shingle weighs 1) or "count" (its occurrences).  The bands use each
    coordinate ``bands * rows / size`` times; at similarity s a pair shares a band with a
    probability of about 1 - (1 - s ** rows) ** bands: 0.99999 at 0.8, 0.001 at 0.25."""

    words: int = 5
    threshold: float = 0.8
    weights: str = "set"
    size: int = 256
    rows: int = 8
    bands: int = 64
    rounds: int = 3
    partners: int = 4
    small: int = 16
    block: int = 256


# ----------------------------------------------------------------------------- shingles and darts
def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_WORDS: dict[str, int] = {}


def word_hashes(words: list[str]) -> np.ndarray:
    if len(_WORDS) > MOST_WORDS:
        _WORDS.clear()
    for w in set(words).difference(_WORDS):
        _WORDS[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def shingles(words: list[str], width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` words, in order; of all words if there are fewer."""
    h = word_hashes(words)
    width = min(width, len(h))
    out = np.zeros(len(h) - width + 1 if width else 0, np.uint64)
    for k in range(width):
        out = mix(out + h[k:k + len(out)] + np.uint64(k + 1))
    return out


def text_shingles(texts: list[list[str]], width: int) -> list[np.ndarray]:
    """The shingles of each text; those of full width are hashed for all texts at once."""
    joined = shingles([w for words in texts for w in words], width)
    out, at = [], 0
    for words in texts:
        out.append(joined[at:at + len(words) - width + 1] if len(words) >= width else shingles(words, width))
        at += len(words)
    return out


def elements(found: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and their weights."""
    if settings.weights == "count":
        found, counts = np.unique(found, return_counts=True)
        return found, counts.astype(float)
    found = np.sort(found)
    found = found[np.diff(found, prepend=found[:1] + np.uint64(1)) != 0]
    return found, np.ones(len(found))


#: Counts of darts by the upper 16 bits of a hash: cumulative Poisson(1) probabilities inverted.
_COUNTS = np.searchsorted(np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 16)])), (np.arange(1 << 16) + 0.5) / (1 << 16))
_UNIT = 1.0 / (1 << 32)


def darts(found: np.ndarray, weights: np.ndarray, until: float) -> tuple[np.ndarray, np.ndarray]:
    """Hash and time of the darts below the elements' weights and before ``until``.

    Weights are tiled in bands [0, 1), [1, 2), [2, 4), [4, 8) ... and time, over a band of width v,
    in strips of height 1 / v, so that each rectangle has area one and is found by its numbers.
    """
    hashes, times = [], []
    band = 0
    while True:
        low, width = (0.0, 1.0) if band == 0 else (2.0 ** (band - 1), 2.0 ** (band - 1))
        over = weights > low
        if not over.any():
            break
        e, w = found[over], weights[over]
        strips = np.arange(int(np.ceil(until * width)), dtype=np.uint64)
        cell = mix(e[:, None] + mix(strips + np.uint64(band << 40))[None, :]).ravel()
        count = _COUNTS[(cell >> np.uint64(48)).astype(np.int64)]
        at = np.repeat(np.arange(len(cell)), count)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        dart = mix(cell[at] + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        spot = mix(dart)  # its two halves are the dart's place in the rectangle
        height = low + width * ((spot >> np.uint64(32)).astype(float) * _UNIT)
        time = ((at % len(strips)) + (spot & np.uint64(0xFFFFFFFF)).astype(float) * _UNIT) / width
        hit = (height < w[at // len(strips)]) & (time < until)
        hashes.append(dart[hit])
        times.append(time[hit])
        band += 1
    return np.concatenate(hashes), np.concatenate(times)


def signature(found: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """At each coordinate the hash of its earliest dart."""
    until = (size * np.log(size) + 3 * size) / weights.sum()
    while True:
        hashes, times = darts(found, weights, until)
        place = (hashes % np.uint64(size)).astype(np.int64)
        order = np.argsort(place + times / until)
        place, hashes = place[order], hashes[order]
        first = np.flatnonzero(np.diff(place, prepend=-1))
        if len(first) == size:
            return hashes[first]
        until *= 2


def band_keys(sign: np.ndarray, settings: Settings) -> np.ndarray:
    """A hash for each band: groups of ``rows`` neighbouring coordinates, then of coordinates a
    stride apart, and so on with further strides."""
    keys, n = [], settings.size // settings.rows
    for turn in range(-(-settings.bands // n)):
        order = np.arange(settings.size).reshape(settings.rows, n) if turn % 2 else np.arange(settings.size).reshape(n, settings.rows).T
        groups = np.roll(sign, turn // 2)[order]
        key = np.arange(turn * n, turn * n + n, dtype=np.uint64)
        for row in groups:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + row)
        keys.append(key)
    return np.concatenate(keys)[:settings.bands]


# ------------------------------------------------------------------------------------ Arrow passes
def _words(text: str) -> list[str]:
    return text.lower().split()


def _digest(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words))


def _signer(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, BATCH_BYTES):
            texts = [_words(t) for t in batch.column(2).to_pylist()]
            digests = [_digest(words) for words in texts]
            bands = [band_keys(signature(*elements(found, settings), settings.size), settings).view(np.int64)
                     if len(found) else np.zeros(0, np.int64) for found in text_shingles(texts, settings.words)]
            offsets = np.cumsum([0, *map(len, bands)]).astype(np.int32)
            values = np.concatenate(bands) if bands else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(offsets, values)],
                names=["doc_id", "text_hash", "node", "bands"])

    return run


def _shingler(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, BATCH_BYTES):
            texts = [_words(t) for t in batch.column(0).to_pylist()]
            digests, parts = [_digest(words) for words in texts], []
            for found in text_shingles(texts, settings.words):
                found, counts = np.unique(found, return_counts=True)
                if settings.weights == "count" and len(found):
                    # The n-th occurrence is an element of its own: sums of least counts are then sizes of intersections.
                    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                    found = mix(np.repeat(found, counts) + mix(nth.astype(np.uint64)))
                parts.append(found.view(np.int64))
            offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.ListArray.from_arrays(offsets, values)],
                                             names=["node", "shingles"])

    return run


def signed(docs: DataFrame, settings: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, node (digest of the words) and bands of each row."""
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("t"))
    kind = T.StructType([rows.schema["doc_id"], T.StructField("text_hash", T.LongType()), T.StructField("node", T.BinaryType()),
                         T.StructField("bands", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(_signer(settings), kind)


# ---------------------------------------------------------------------------------------- classes
def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose similarity reaches the threshold."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(a, "a").join(b, "b")
            .where(both >= threshold * (F.size("sa") + F.size("sb") - both) - 1e-9).select("a", "b"))


def _with_links(labels: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Labels (node, label) after joining the classes of linked nodes."""
    of = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    to = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    classes = connected_components(links.join(of, "a").join(to, "b").select("la", "lb").distinct(), scratch, "la", "lb")
    new = classes.select(F.col("node").alias("label"), F.col("label").alias("new"))
    out = scratch.table(labels.join(new, "label", "left").select("node", F.coalesce("new", "label").alias("label")))
    scratch.drop(labels, links, classes)
    return out


def _some(df: DataFrame) -> bool:
    return df.limit(1).count() > 0


def duplicate_classes(docs: DataFrame, rows: DataFrame, settings: Settings, id_col: str, text_col: str,
                      scratch: Scratch) -> DataFrame:
    """(node, class_node) for the nodes that are in a class with others; ``rows``: signed docs."""
    # One row per node, with a document that has its text.
    nodes = scratch.table(rows.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash", "bands")).alias("x"))
                          .select("node", "x.doc_id", "x.text_hash", "x.bands"))
    entries = nodes.select("node", F.explode("bands").alias("key"))
    shared = scratch.table(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = scratch.table(entries.join(shared, "key"))
    labels = scratch.table(members.select("node").distinct().withColumn("label", F.col("node")))

    # The shingles of candidates alone, by one document of each.
    wanted = nodes.join(labels, "node", "left_semi").select(F.col("doc_id").alias("w1"), F.col("text_hash").alias("w2"))
    text = whole_text(docs[text_col])
    found = docs.join(wanted, docs[id_col].eqNullSafe(wanted["w1"]) & (F.xxhash64(text) == wanted["w2"]), "left_semi")
    kind = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("shingles", T.ArrayType(T.LongType()))])
    sets = scratch.table(found.select(whole_text(text_col).alias("t")).mapInArrow(_shingler(settings), kind).dropDuplicates(["node"]))
    scratch.drop(nodes, shared)

    def joined(labels: DataFrame, links: DataFrame) -> tuple[DataFrame, bool]:
        links = scratch.table(links)
        return (_with_links(labels, links, scratch), True) if _some(links) else (labels, False)

    for turn in range(settings.rounds):
        pairs = scratch.table(_leader_pairs(members, labels, turn, settings.partners, scratch))
        labels, more = joined(labels, _verified(pairs, sets, settings.threshold))
        scratch.drop(pairs)
        if not more:
            break
    dense = _dense_groups(members, labels, settings, scratch)
    groups = dense.withColumnRenamed("label", "group")
    if _some(groups):
        labels, _ = joined(labels, _block_links(groups, labels, sets, settings, scratch))
    labels, _ = joined(labels, _verified(_small_pairs(members, labels, groups, settings), sets, settings.threshold))
    scratch.drop(members, sets, dense)
    return labels.withColumnRenamed("label", "class_node")


def _leader_pairs(members: DataFrame, labels: DataFrame, turn: int, partners: int, scratch: Scratch) -> DataFrame:
    """Each node with leaders of its buckets in other classes: in the first turn the least of them,
    later those that a hash of the turn puts first.  The last steps cover all others."""
    placed = members.join(labels, "node")
    order = F.col("node") if turn == 0 else F.xxhash64("node", F.lit(turn))
    leaders = scratch.table(placed.groupBy("key").agg(F.min(F.struct(order.alias("o"), F.col("node").alias("b"), F.col("label").alias("lb"))).alias("x"))
                            .select("key", "x.b", "x.lb", "x.o"))
    pairs = placed.join(leaders, "key").where("label != lb").select(F.col("node").alias("a"), "b", "o").distinct()
    if turn == 0:
        return pairs.groupBy("a").agg(F.min("b").alias("b"))
    # At most one entry per band in an array.
    best = pairs.groupBy("a").agg(F.slice(F.sort_array(F.collect_list(F.struct("o", "b"))), 1, partners).alias("x"))
    return best.select("a", F.explode("x.b").alias("b"))


def _dense_groups(members: DataFrame, labels: DataFrame, settings: Settings, scratch: Scratch) -> DataFrame:
    """(node, label) of nodes in large buckets with several classes, by group: buckets with a
    node in common are one."""
    placed = members.where(F.col("n") > settings.small).join(labels, "node")
    open_ = scratch.table(placed.groupBy("key").agg(F.min("node").alias("b"), F.min("label").alias("l1"), F.max("label").alias("l2"))
                          .where("l1 != l2").select("key", "b"))
    edges = members.where(F.col("n") > settings.small).join(open_, "key").select(F.col("node").alias("a"), "b")
    return connected_components(edges, scratch)


def _block_links(groups: DataFrame, labels: DataFrame, sets: DataFrame, settings: Settings, scratch: Scratch) -> DataFrame:
    """Links (a, b) between classes within each group, found block by block."""
    placed = groups.join(labels, "node")
    sizes = placed.groupBy("group", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("group").agg(F.max(F.struct("n", "label")).alias("x"), F.sum("n").alias("all"))

    def blocks(n):
        return F.ceil(n / settings.block).cast("int")

    # The largest class has blocks 0 .. core - 1, the others core .. total - 1.
    # Written, so that the join to it is one that Spark can split at a large group.
    sizes = scratch.table(sizes.select("group", F.col("x.label").alias("largest"), blocks(F.col("x.n")).alias("core"),
                                       (blocks(F.col("x.n")) + blocks(F.col("all") - F.col("x.n"))).alias("total")))
    placed = placed.join(sizes, "group").withColumn("most", F.col("label") == F.col("largest"))
    spread = F.xxhash64("node", F.lit(3))
    placed = placed.withColumn("own", F.when(F.col("most"), F.pmod(spread, "core")).otherwise(
        F.col("core") + F.pmod(spread, F.greatest(F.lit(1), F.col("total") - F.col("core")))).cast("int"))
    # A node goes to each meeting of its block with another: with every block of other classes.
    others = F.sequence(F.col("core"), F.col("total") - 1)
    met = F.when(F.col("core") == F.col("total"), F.array().cast("array<int>")).when(F.col("most"), others).otherwise(
        F.sequence(F.lit(0), F.col("total") - 1))
    meets = placed.select("group", "node", "label", "own", F.explode(met).alias("other"))
    meets = meets.select("group", "node", "label", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    return meets.join(sets, "node").groupBy("group", "x", "y").applyInPandas(_meet(settings.threshold), "a binary, b binary")


def _meet(threshold: float):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        sets = [np.asarray(x, np.int64) for x in block["shingles"]]
        sizes = np.array([len(x) for x in sets])
        # Bits of the shingles that two nodes have, by node.
        _, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row, met = np.repeat(np.arange(len(sets)), sizes), counts[place] > 1
        number = np.cumsum(counts > 1) - 1
        width = -(-int((counts > 1).sum()) // 64) or 1
        bits = np.zeros((len(sets), width), np.uint64)
        bit = number[place[met]]
        np.bitwise_or.at(bits, (row[met], bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
        _, label = np.unique(block["label"].map(bytes).to_numpy(), return_inverse=True)
        nodes, own, links = block["node"].tolist(), block["own"].to_numpy(), []
        itself = block["x"].iloc[0] == block["y"].iloc[0]
        for i in range(len(sets) - 1):
            # Two blocks that meet have each met themselves elsewhere.
            later = np.flatnonzero((label[i + 1:] != label[i]) & (itself | (own[i + 1:] != own[i]))) + i + 1
            both = np.bitwise_count(bits[later] & bits[i]).sum(axis=1)
            for j in later[both >= threshold * (sizes[later] + sizes[i] - both) - 1e-9]:
                if label[i] != label[j]:
                    links.append((nodes[i], nodes[j]))
                    label[label == label[j]] = label[i]
        return pd.DataFrame(links, columns=["a", "b"])

    return run


def _small_pairs(members: DataFrame, labels: DataFrame, groups: DataFrame, settings: Settings) -> DataFrame:
    """Pairs of different classes within a bucket of at most ``small`` nodes, unless their
    group has compared them."""
    placed = members.where(F.col("n") <= settings.small).join(labels, "node").join(groups, "node", "left")
    mine = placed.select("key", F.col("node").alias("a"), F.col("label").alias("la"), F.col("group").alias("ga"))
    other = placed.select("key", F.col("node").alias("b"), F.col("label").alias("lb"), F.col("group").alias("gb"))
    return mine.join(other, "key").where("a < b and la != lb and (ga is null or gb is null or ga != gb)").select("a", "b").distinct()


def _classified(docs: DataFrame, settings: Settings, id_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    """doc_id, text_hash, class_node and class_id of each row."""
    rows = scratch.table(signed(docs, settings, id_col, text_col))
    classes = duplicate_classes(docs, rows, settings, id_col, text_col, scratch)
    own = rows.select("doc_id", "text_hash", "node")
    least = own.groupBy("node").agg(F.min("doc_id").alias("least"))
    of_node = least.join(classes, "node", "left").select("node", "least", F.coalesce("class_node", "node").alias("class_node"))
    of_class = of_node.groupBy("class_node").agg(F.min("least").alias("class_id"))
    ids = scratch.table(of_node.join(of_class, "class_node").select("node", "class_node", "class_id"))
    return own.join(ids, "node").drop("node")


def near_duplicates(docs: DataFrame, settings: Settings | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text_hash, class_id, and whether it is the class's ``first``."""
    found = _classified(docs, settings or Settings(), id_col, text_col, Scratch(docs.sparkSession))
    return found.select("doc_id", "text_hash", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("first"))


def drop_near_duplicates(docs: DataFrame, settings: Settings | None = None, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """One row of each class, columns as given."""
    scratch = Scratch(docs.sparkSession)
    found = _classified(docs, settings or Settings(), id_col, text_col, scratch)
    firsts = found.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    # A class may have several rows with its id: other texts (the least stays), or the row repeated.
    kept = scratch.table(firsts.groupBy("class_node").agg(
        F.min("class_id").alias("i"), F.min("text_hash").alias("h"), F.count(F.lit(1)).alias("n")))

    def rows_of(keys: DataFrame) -> DataFrame:
        return docs.join(keys, docs[id_col].eqNullSafe(keys["i"]) & (F.xxhash64(whole_text(docs[text_col])) == keys["h"]), "left_semi")

    once = rows_of(kept.where("n = 1"))
    if not _some(kept.where("n > 1")):
        return once
    return once.unionByName(rows_of(kept.where("n > 1")).dropDuplicates([id_col, text_col]))
