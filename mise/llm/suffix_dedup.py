"""Exact substring dedup: every byte covered by a string of SIZE bytes that starts anywhere else goes.

Sorting all suffixes of a corpus together would need every shard to meet every other.  So the text
is dealt out by content first.  Each string of SIZE bytes has an anchor: of the runs of GRAM bytes
within it, the one of least hash (the first of equals).  Equal strings have equal anchors at the
same place.  Strings next to each other mostly share an anchor; those of one anchor make an item:
the bytes from the first such string's start to the last one's end.  Equal strings can only be in
items whose anchors have the same hash, so these meet and no others need to:

1. Items are counted by anchor hash and content hash.  One that occurs twice is covered whole.  This
   settles copies and the inside of shared passages, however many documents hold them.
2. Of anchors with several different items, one of which occurs once, one copy of each item is
   fetched, and items are put in shards by anchor.  Each shard gets suffix arrays
   (Larsson-Sadakane), Kasai's common prefixes, and a binary search of what one array doesn't settle
   in the others (:func:`mise.llm.suffix_sort.repeated_strings`).
3. Anchors with more than MOST_ITEMS different items would make a shard too large: their strings
   are counted one by one, by two 64-bit hashes, which spreads them over all tasks.

The covered ranges go back to the documents that hold the items.  Documents with the same text are
told apart only at the end: work on texts is done once for each.

Defined results: a null text is empty; texts shorter than SIZE bytes keep all; repeated rows are
copies of each other, so all of their bytes go if there are SIZE or more; offsets count bytes of
UTF-8 and the remaining bytes need not be valid UTF-8; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_rows, whole_text
from .suffix_sort import repeated_strings

SIZE = 400
GRAM = 64
#: Bytes of text worked on at once, of items in a shard on average, and of a suffix array at most.  A worker needs about
#: 70 bytes for each of the first and 90 for each byte of an array.  Shards differ in size, and a second array
#: in one costs a search in the other, so the average leaves room for most shards to be one array.
BATCH_BYTES, SHARD_BYTES, CHUNK_BYTES = 500_000, 500_000, 2_000_000
MOST_ITEMS = 20_000

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_TABLE = np.random.default_rng(9).integers(0, 1 << 64, 256, np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS: dict[str, np.ndarray] = {"up": np.zeros(0, np.uint64), "down": np.zeros(0, np.uint64)}


def _up_down(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        _POWERS["up"] = _powers(_BASE, n)
        _POWERS["down"] = _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), n)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes from each position, all from one running sum."""
    up, down = _up_down(len(data))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * up, dtype=np.uint64)))
    h = (total[width:] - total[:-width]) * down[:len(data) - width + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Least of the ``width`` values from each position: running minima from both ends of blocks."""
    n = len(values)
    full = np.full(-(-n // width) * width, np.uint64((1 << 64) - 1))
    full[:n] = values
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def items(texts: list[bytes], size: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, content hash, first start, last start, anchor place) of all items."""
    sizes = np.array([len(t) for t in texts], np.int64)
    if not (sizes >= size).any():
        return (np.zeros(0, np.int64),) * 6
    joined = b"".join(texts)
    starts = np.cumsum(sizes) - sizes
    hashes = gram_hashes(np.frombuffer(joined, np.uint8), gram)
    # The upper half of the hash, then the place, so that the first of equals is the least.
    keyed = (hashes & ~np.uint64(0xFFFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    anchors = (least_in_window(keyed, size - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    long = np.flatnonzero(sizes >= size)
    counts = sizes[long] - size + 1
    text = np.repeat(long, counts)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + starts[text]
    anchor = anchors[at]
    first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))))
    last = np.append(first[1:], len(at)) - 1
    text, anchor, p1, p2 = text[first], anchor[first], at[first], at[last]
    content = np.fromiter((xxhash.xxh3_64_intdigest(joined[a:b + size], seed=c) for a, b, c in zip(p1.tolist(), p2.tolist(), (anchor - p1).tolist())),
                          np.uint64, len(p1))
    return text, hashes[anchor].view(np.int64), content.view(np.int64), p1 - starts[text], p2 - starts[text], anchor - p1


def _item_rows(size: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, BATCH_BYTES):
            text, anchor, content, p1, p2, place = items([t.encode() for t in batch.column(1).to_pylist()], size, gram)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(text)), pa.array(anchor), pa.array(content),
                 *[pa.array(x.astype(np.int32)) for x in (p1, p2, place)]], names=["key", "h", "c", "p1", "p2", "place"])

    return run


def _ranges(repeated: np.ndarray, size: int) -> list[dict[str, int]]:
    """Byte ranges covered by the strings that start where marked."""
    starts = np.flatnonzero(repeated)
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > size)
    return [{"s": int(a), "e": int(b) + size} for a, b in zip(starts[np.concatenate(([0], gap + 1))], starts[np.append(gap, len(starts) - 1)])]


def _sort_shard(size: int, chunk_bytes: int):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        # By anchor, so that what can be equal mostly shares a suffix array.
        shard = shard.sort_values(["h", "c"], kind="stable")
        found = [_ranges(x, size) for x in repeated_strings([bytes(x) for x in shard["bytes"]], size, chunk_bytes)]
        shard = shard.assign(ranges=found)[["h", "c", "n", "ranges"]]
        return shard[(shard["n"] == 1) & (shard["ranges"].map(len) > 0)][["h", "c", "ranges"]]

    return run


def _single_strings(size: int):
    """All strings of an item, by place relative to the anchor and a hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in range(0, batch.num_rows, 256):
                part = batch.slice(step, 256).to_pydict()
                row, start, hash_ = [], [], []
                for i, data in enumerate(part["bytes"]):
                    for k in range(len(data) - size + 1):
                        row.append(i)
                        start.append(k)
                        hash_.append(xxhash.xxh3_64_intdigest(data[k:k + size], seed=part["place"][i] - k) - (1 << 63))
                pick = [pa.array([part[c][i] for i in row], pa.int64()) for c in ("h", "c", "n")]
                yield pa.RecordBatch.from_arrays([*pick, pa.array(start, pa.int32()), pa.array(hash_, pa.int64())], names=["h", "c", "n", "k", "x"])

    return run


def covered_items(docs: DataFrame, located: DataFrame, size: int, shard_bytes: int, most_items: int, scratch: Scratch) -> DataFrame:
    """(h, c, ranges) of items with covered bytes; null ranges: the whole item.  ``docs``: (key,
    text), each text once; ``located``: (key, h, c, p1, p2, place, n, m) of items to be looked at,
    n times in all, of m different ones with their anchor."""
    whole = located.where("n > 1").select("h", "c").distinct().withColumn("ranges", F.lit(None).cast("array<struct<s:int,e:int>>"))
    one = located.where("open").groupBy("h", "c").agg(F.min(F.struct("key", "p1", "p2", "place", "n", "m")).alias("x")).select("h", "c", "x.*")
    data = F.expr(f"substring(cast(text as binary), p1 + 1, p2 - p1 + {size})")
    fetched = scratch.table(one.join(docs, "key").select("h", "c", "n", "m", "place", data.alias("bytes")))
    shards = -(-(fetched.where(F.col("m") <= most_items).agg(F.sum(F.length("bytes"))).first()[0] or 0) // shard_bytes)
    small = fetched.where(F.col("m") <= most_items).select("h", "c", "n", "bytes", F.pmod(F.xxhash64("h"), F.lit(max(1, shards))).alias("shard"))
    sorted_ = small.groupBy("shard").applyInPandas(_sort_shard(size, CHUNK_BYTES), "h long, c long, ranges array<struct<s:int,e:int>>")
    large = fetched.where(F.col("m") > most_items)
    strings = large.select("h", "c", "n", "place", "bytes").mapInArrow(_single_strings(size), "h long, c long, n long, k int, x long")
    twice = strings.groupBy("h", "x").agg(F.sum("n").alias("all")).where("all > 1").select("h", "x")
    singles = (strings.where("n = 1").join(twice, ["h", "x"]).groupBy("h", "c")
               .agg(F.collect_list(F.struct(F.col("k").alias("s"), (F.col("k") + size).cast("int").alias("e"))).alias("ranges")))
    return whole.unionByName(sorted_).unionByName(singles)


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge each text's ranges and hash what is left."""
    for batch in arrow_rows(batches, BATCH_BYTES):
        removed, runs, digests = [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            data, kept, at, n, gone = text.encode(), hashlib.sha256(), 0, 0, 0
            last = -1
            for s, e in sorted((x["s"], x["e"]) for x in spans):
                if s > last:
                    n += 1
                    kept.update(data[at:s])
                    gone += e - s
                    at = last = e
                elif e > last:
                    gone += e - last
                    at = last = e
            kept.update(data[at:])
            removed.append(gone)
            runs.append(n)
            digests.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests)],
                                         names=["key", "n_removed", "n_spans", "kept_sha256"])


def removed_bytes(docs: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM,
                  shard_bytes: int = SHARD_BYTES, most_items: int = MOST_ITEMS) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans and kept_sha256."""
    if gram > size:
        raise ValueError("an anchor must fit in a string")
    scratch = Scratch(docs.sparkSession)
    text = whole_text(text_col)
    key = F.unhex(F.md5(text))
    keyed = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"), text.alias("text"))
    rows = keyed.select("key", "text").where(F.octet_length("text") >= size).mapInArrow(
        _item_rows(size, gram), "key binary, h long, c long, p1 int, p2 int, place int")

    # 1. How often each item occurs, and how many different ones its anchor has.
    counts = rows.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"))
    met = counts.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"), F.min("n").alias("fewest")).where("total > 1")
    status = scratch.table(counts.join(met, "h").select("h", "c", "n", "m", ((F.col("m") > 1) & (F.col("fewest") == 1)).alias("open")).where("n > 1 or open"))
    located = scratch.table(rows.join(status, ["h", "c"]))

    # 2, 3. One row for each text that holds such an item, and what of the items is covered.
    texts = keyed.groupBy("key").agg(F.min("doc_id").alias("one"))
    wanted = texts.join(located.select("key").distinct(), "key").select(F.col("key").alias("k"), "one")
    once = scratch.table(keyed.join(wanted, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("one")), "left_semi").select("key", "text"))
    covered = scratch.table(covered_items(once, located, size, shard_bytes, most_items, scratch))

    # Back to the texts: at most the items of one text in a group.
    shifted = F.transform(F.coalesce("ranges", F.array(F.struct(F.lit(0).alias("s"), (F.col("p2") - F.col("p1") + size).cast("int").alias("e")))),
                          lambda x: F.struct((x["s"] + F.col("p1")).alias("s"), (x["e"] + F.col("p1")).alias("e")))
    spans = located.select("key", "h", "c", "p1", "p2").join(covered, ["h", "c"]).select("key", F.explode(shifted).alias("x"))
    spans = spans.groupBy("key").agg(F.collect_set("x").alias("spans"))
    stripped = scratch.table(once.dropDuplicates(["key"]).join(spans, "key").select("key", "text", "spans").mapInArrow(
        _strip, "key binary, n_removed long, n_spans long, kept_sha256 string"))
    light = keyed.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("own"))
    return light.join(stripped, "key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept_sha256", "own").alias("kept_sha256"))
