"""Token counts by the public vocabulary files.

Texts go to Arrow functions in batches of about equal bytes; only lengths come back.  A text is cut
into units at boundaries that no token can cross: before a single space or line feed between two
characters that are no white space, and after such a line feed.  The pattern that the byte-level
vocabularies split by has a token take white space only in front of it, or as a run of its own, so
the tokens of a text are those of its units in order.  Special strings hold no white space and
thus lie within one unit.  Units repeat, so each worker keeps the tokens of those it has met, up to
a bound, and encodes the others of a batch together.

Units of Latin letters, digits and ASCII signs are encoded by a faster library from the same
file's vocabulary and merges, which gives the same ids; all others by the file's own library.

Defined results: a null text is empty and has no tokens; repeated rows are counted each; a long
text without any boundary is one unit and is encoded whole, as is any text of a ``.model`` file, whose tokens may
cross spaces; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, portions

#: Bytes of text encoded at once.
BATCH_BYTES = 2_000_000
#: Characters given to the encoder at once.
PORTION_CHARS = 200_000
#: Units a worker remembers at most, and the longest it remembers, in characters.
MOST_UNITS, LONGEST_UNIT = 600_000, 48

_BOUNDARY = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=\S\n)(?=\S)")
#: Words whose characters are in the same class in every version of Unicode, without white space.
_PLAIN = re.compile(r"[!-~\u00a1-\u00ac\u00ae-\u024f]+")


def text_units(text: str) -> list[str]:
    """The text cut at boundaries that no token crosses; joined, the units are the text."""
    return _BOUNDARY.split(text)


def has_plain_spaces(text: str) -> bool:
    """Whether all white space is single spaces and line feeds between words."""
    return " ".join(text.split()) == text.replace("\n", " ")


class PlainWords:
    """Encodes many words at once by the ranks in a byte-level file, or not at all if the file's
    ids aren't the ranks of its merges."""

    #: Splits text as the byte-level pre-tokenizer does (fixed value).
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        self._encoding = None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, own = spec["model"], spec.get("pre_tokenizer") or {}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model.get("merges", [])]
        vocab = model.get("vocab", {})
        if (spec.get("normalizer") or spec.get("post_processor") or own.get("type") != "ByteLevel" or own.get("add_prefix_space")
                or not own.get("use_regex") or model.get("type") != "BPE" or model.get("end_of_word_suffix")
                or model.get("continuing_subword_prefix") or model.get("ignore_merges")
                or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges))):
            return
        # The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        to_byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in shown)}
        special = {x["content"] for x in spec.get("added_tokens", [])}
        ranks = {bytes(to_byte[c] for c in t): i for t, i in vocab.items() if t not in special}
        import tiktoken

        self._encoding = tiktoken.Encoding("own", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for t, i in ranks.items():
            self._bytes[i] = len(t)
        self._special = special

    def takes(self, word: str) -> bool:
        return self._encoding is not None and _PLAIN.fullmatch(word) is not None and not any(x in word for x in self._special)

    def ids(self, words: list[str], before: str) -> list[bytes]:
        """Ids of each word with ``before`` (a space or nothing) in front of it.  The words are
        encoded as lines of one text: no token crosses a line feed between other characters."""
        if not words:
            return []
        ids = np.asarray(self._encoding.encode_ordinary("\n".join(before + w for w in words)), "<u4")
        ends = np.cumsum(self._bytes[ids])
        lengths = np.array([len(w.encode()) for w in words]) + len(before)
        word_ends = np.cumsum(lengths + 1) - 1
        last = np.searchsorted(ends, word_ends) + 1
        first = np.concatenate(([0], last[:-1] + 1))
        raw = ids.tobytes()
        return [raw[4 * a:4 * b] for a, b in zip(first.tolist(), last.tolist())]


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            own.no_truncation()
            own.no_padding()
            self._encode = lambda texts: [e.ids for e in own.encode_batch_fast(texts, add_special_tokens=False)]
            self._plain = PlainWords(path)
            self._split = self._plain._encoding is not None
        else:
            import sentencepiece

            piece = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: piece.encode(texts, num_threads=1)
            self._split = False  # its tokens may cross spaces
        self._at_start: dict[str, bytes] = {}
        self._after_space: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        # A long text comes as its units: the encoder gets them in portions.
        return [np.asarray(x, "<u4").tobytes() for part in portions(texts, PORTION_CHARS) for x in self._encode(part)]

    def _known(self, kept: dict[str, bytes], words: set[str], before: str) -> dict[str, bytes]:
        """Ids by word; those short enough are kept for later batches."""
        missing = words.difference(kept)
        if len(kept) + len(missing) > MOST_UNITS:
            kept.clear()
            missing = words
        plain = [w for w in missing if self._plain.takes(w)]
        new = dict(zip(plain, self._plain.ids(plain, before)))
        other = [w for w in missing if w not in new]
        new |= zip(other, self._whole([before + w for w in other]))
        kept.update((w, x) for w, x in new.items() if len(w) <= LONGEST_UNIT)
        return kept if all(len(w) <= LONGEST_UNIT for w in new) else kept | new

    def ids(self, texts: list[str]) -> list[bytes]:
        if not self._split:
            return self._whole(texts)
        # By text: its lines as lists of words, or its units where white space is not that plain.
        plain = [has_plain_spaces(t) for t in texts]
        cut = [[line.split(" ") for line in t.split("\n")] if p else text_units(t) for t, p in zip(texts, plain)]
        start, space = {"\n"}, set()
        for p, parts in zip(plain, cut):
            if p:
                for words in parts:
                    start.add(words[0])
                    space.update(words[1:])
            else:
                start.update(parts)
        at_start = self._known(self._at_start, start, "")
        after_space = self._known(self._after_space, space, " ").__getitem__
        out, feed = [], at_start["\n"]
        for p, parts in zip(plain, cut):
            if p:
                out.append(feed.join([b"".join([at_start[words[0]], *map(after_space, words[1:])]) for words in parts]))
            else:
                out.append(b"".join(map(at_start.__getitem__, parts)))
        return out

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(x) // 4 for x in self.ids(texts)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; workers are reused by later tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def token_counts(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, bytes and tokens of the text, and whether the tokens exceed ``limit``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in arrow_rows(batches, BATCH_BYTES):
            n = pa.array(enc.lengths(batch.column(2).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], names=["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("t"))
    kind = T.StructType([rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return rows.mapInArrow(count, kind).withColumn("over_limit", F.col("n_tokens") > limit)
