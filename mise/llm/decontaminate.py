"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may be met with up to floor(error_rate m) edits (insertions, deletions,
replacements).  It is split into one piece more than that: in any such passage one piece at least
is free of edits.  An Aho-Corasick automaton finds all exact piece hits of a block of items in one
pass over each text; around each hit, Myers' bit-parallel method then gives the least distance of
the whole item to any passage there.

Characters are compared in lower case, with tabs, feeds and returns as spaces; both keep offsets.
The benchmark may be of any size: items are taken in blocks of bounded bytes, each sent to the
executors by itself.  Items of fewer than MIN_CHARS characters, which edits would turn into other
phrases, are met without edits and at word boundaries only.  After a passage is found, what lies on
both sides of it is searched for further ones.

Defined results: null texts and null items match nothing, nor do items without a letter or digit;
white space around a short item doesn't count; repeated rows of documents are reported each, repeated
rows of the benchmark once; if two item ids have the same text, both are reported; an empty table on
either side gives an empty result; filtering carries other columns through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import arrow_rows

ERROR_RATE = 0.05
MIN_CHARS = 24
#: Bytes of items sent to the executors at once, and of texts searched at once.
BLOCK_BYTES, BATCH_BYTES = 8_000_000, 4_000_000

MATCH = [T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("distance", T.LongType())]


def folded(text: str) -> str:
    """Lower case and plain spaces, character by character."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for c in "\n\t\r\x0b\x0c":
        low = low.replace(c, " ")
    return low


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """The item cut into budget + 1 pieces of about equal length: (offset, piece)."""
    n = budget + 1
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any substring of the text, and where the first such
    substring ends.  One machine word holds the whole pattern (Python's integers have any width)."""
    m = len(pattern)
    places: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        places[c] |= 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = mask, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = places.get(c, 0)
        diagonal = ((((eq & plus) + plus) ^ plus) | eq | minus) & mask
        up = minus | (mask & ~(diagonal | plus))
        down = plus & diagonal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = (up << 1) & mask, (down << 1) & mask
        plus = down | (mask & ~(diagonal | up))
        minus = up & diagonal
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """A block of items, as (folded text, ids)."""

    def __init__(self, items: list[tuple[str, list]], error_rate: float):
        import ahocorasick

        self.items = items
        self.budgets = [int(len(t) * error_rate) if len(t) >= MIN_CHARS else 0 for t, _ in items]
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (t, _) in enumerate(items):
            for offset, piece in pieces(t, self.budgets[k]):
                found[piece].append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, start, end, distance) of the passages in each stretch with piece hits: the best one, then those beside it."""
        text = folded(text)
        around: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for last, (size, where) in self.automaton.iter(text):
            for k, offset in where:
                start = last + 1 - size - offset
                if len(self.items[k][0]) < MIN_CHARS:
                    if _is_whole(text, start, last + 1):
                        around[k].append((start, last + 1))
                    continue
                e = self.budgets[k]
                around[k].append((max(0, start - e), start + len(self.items[k][0]) + e))
        for k in sorted(around):
            if len(self.items[k][0]) < MIN_CHARS:
                end = 0
                for a, b in around[k]:
                    if a >= end:
                        end = b
                        yield k, a, b, 0
                continue
            for a, b in _joined(around[k]):
                yield from self._passages(k, text, a, min(b, len(text)))

    def _passages(self, k: int, text: str, a: int, b: int) -> Iterator[tuple[int, int, int, int]]:
        """All passages of a stretch that don't overlap a better one, from left to right."""
        least = len(self.items[k][0]) - self.budgets[k]
        found, todo = [], [(a, b)]
        while todo:
            a, b = todo.pop()
            match = self._best(k, text, a, b) if b - a >= least else None
            if match:
                found.append(match)
                todo += [(a, match[1]), (match[2], b)]
        yield from sorted(found)

    def _best(self, k: int, text: str, a: int, b: int) -> tuple[int, int, int, int] | None:
        item = self.items[k][0]
        at = text.find(item, a, b)
        if at >= 0:
            return k, at, at + len(item), 0
        distance, end = myers(item, text[a:b])
        if distance > self.budgets[k]:
            return None
        # The passage's start: the best match of both reversed, backwards from its end.
        _, size = myers(item[::-1], text[a:a + end][::-1])
        return k, a + end - size, a + end, distance


def _is_whole(text: str, a: int, b: int) -> bool:
    """No word goes on beyond either end."""
    return not (a > 0 and text[a - 1].isalnum() and text[a].isalnum()) and not (b < len(text) and text[b].isalnum() and text[b - 1].isalnum())


def _joined(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


_MATCHERS: dict[tuple[str, float], Matcher] = {}


def find_passages(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document, item and passage: the ids, offsets in the text (code points, end
    exclusive) and edit distance."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")).where("t is not null")
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("t"))
    schema = T.StructType([rows.schema["doc_id"], items.schema["item_id"], *MATCH])
    out = spark.createDataFrame([], schema)
    for known in item_blocks(items, block_bytes):
        out = out.union(rows.mapInArrow(_searcher(_sent(spark, known), error_rate, schema), schema))
    return out


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, list]]]:
    """The items as lists of (folded text, ids), each list of about ``block_bytes`` of text."""
    items = items.where("t is not null").distinct()
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    for b in range(blocks):
        # Driver-side: one block.  Equal texts get the same block, so that each is searched once.
        by_text: dict[str, list] = defaultdict(list)
        for r in items.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == b).collect():
            t = folded(r["t"])
            by_text[t if len(t) >= MIN_CHARS else t.strip()].append(r["item_id"])
        known = sorted((t, sorted(ids, key=lambda x: (x is None, x))) for t, ids in by_text.items() if any(c.isalnum() for c in t))
        if known:
            yield known


def _sent(spark, known: list[tuple[str, list]]) -> tuple[str, object]:
    """A block's name and its broadcast."""
    return hashlib.sha256(repr(known).encode()).hexdigest(), spark.sparkContext.broadcast(known)


def _matcher(block, error_rate: float) -> Matcher:
    """The worker's matcher for a block, kept for its later tasks."""
    name, known = block
    if (name, error_rate) not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[name, error_rate] = Matcher(known.value, error_rate)
    return _MATCHERS[name, error_rate]


def _searcher(block, error_rate: float, schema: T.StructType):
    item_type = to_arrow_type(schema["item_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(block, error_rate)
        for batch in arrow_rows(batches, BATCH_BYTES):
            found = [(i, item, a, b, d) for i, t in enumerate(batch.column(1).to_pylist())
                     for k, a, b, d in matcher.matches(t) for item in matcher.items[k][1]]
            at, item, *rest = zip(*found) if found else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(item, item_type),
                 *[pa.array(x, pa.int64()) for x in rest]], names=schema.names)

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, text_col: str = "text",
                      item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows in whose text no item is found, columns as given.  Nothing is shuffled."""
    place = docs.columns.index(text_col)
    items = benchmark.select(F.lit(0).alias("item_id"), F.col(item_text_col).alias("t"))
    for known in item_blocks(items, block_bytes):
        docs = docs.mapInArrow(_filter(_sent(docs.sparkSession, known), error_rate, place), docs.schema)
    return docs


def _filter(block, error_rate: float, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(block, error_rate)
        for batch in arrow_rows(batches, BATCH_BYTES):
            clean = [t is None or next(matcher.matches(t), None) is None for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run
