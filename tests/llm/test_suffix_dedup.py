import collections
import hashlib
import random

import numpy as np
import pytest

from mise.llm import suffix_dedup as S
from mise.llm import suffix_sort as A
from tests.llm.conftest import EDGE_ROWS


def strings(rng, n, alphabet="abcdefghij é"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def brute(rows, size):
    data = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(b[i:i + size] for b in data for i in range(len(b) - size + 1))
    out = []
    for (d, _), b in zip(rows, data):
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        kept = bytes(x for x, y in zip(b, gone) if not y)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(docs, **how):
    return sorted((tuple(r) for r in S.removed_bytes(docs, **how).collect()), key=str)


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for n in (0, 1, 7, 8, 9, 300, 2000):
        for alphabet in ("a", "ab", "abcdefgh", "\0a"):
            text = strings(rng, n, alphabet).encode()
            data = np.frombuffer(text, np.uint8)
            at = A.words(data, 60)
            order = A.suffix_array(at, n)
            assert order.tolist() == sorted(range(n), key=lambda i: text[i:])
            shared = A.common_prefixes(at, order, 50, block=64)
            for x in range(1, n):
                u, v = text[order[x - 1]:], text[order[x]:]
                same = next((k for k, (p, q) in enumerate(zip(u, v)) if p != q), min(len(u), len(v)))
                assert shared[x] == min(50, same)


def test_repeated_strings_in_one_and_several_arrays():
    rng = random.Random(2)
    for trial in range(60):
        size, items = rng.choice([9, 16, 20, 33]), []
        for _ in range(rng.randint(1, 9)):
            item = strings(rng, rng.randint(0, 120), "ab" if trial % 2 else "abcdefgh").encode()
            if items and rng.random() < 0.6:
                item = item[:20] + rng.choice(items)[rng.randint(0, 30):][:60] + item[20:40]
            items.append(item)
        seen = collections.Counter(x[i:i + size] for x in items for i in range(len(x) - size + 1))
        want = [[seen[x[i:i + size]] > 1 for i in range(len(x) - size + 1)] for x in items]
        for chunk in (40, 100, 10**6):
            assert [x.tolist() for x in A.repeated_strings(items, size, chunk)] == want


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    p, q = strings(rng, 450), strings(rng, 700)
    out = [(i, strings(rng, 200 + i) + (p if i % 3 else q) + strings(rng, 300)) for i in range(24)]
    out += [(100, strings(rng, 399)), (103, "ab" * 600), (104, q), (105, q), (106, "x" + "ab" * 250), (107, q[:399]), (108, q[100:500] + "!")]
    return out + [(200 + i, out[i][1][:300] + "#" + out[i][1][301:]) for i in range(8)] + EDGE_ROWS


@pytest.mark.parametrize("how", [{}, {"most_items": 2}, {"shard_bytes": 3000}])
def test_against_counting_all_strings(clashing, rows, how, monkeypatch):
    monkeypatch.setattr(S, "CHUNK_BYTES", 4000 if how else S.CHUNK_BYTES)
    assert result(clashing(rows), **how) == brute(rows, S.SIZE)


def test_other_sizes(make):
    rng = random.Random(4)
    rows = [(i, strings(rng, rng.randint(0, 150), "ab") + strings(rng, 40)) for i in range(40)]
    assert result(make(rows), size=24, gram=8) == brute(rows, 24)


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert result(docs) == brute([tuple(r) for r in docs.collect()], S.SIZE)


def test_empty(make):
    assert result(make([])) == []
    assert result(make([(1, None), (2, "")])) == brute([(1, None), (2, "")], S.SIZE)


def test_all_strings_of_a_whole_table(spark):
    """The query on sf0.1 against counting every 400-byte string by a rolling hash: all columns of all rows."""
    import hashlib

    import numpy as np

    from mise.llm import queries
    from mise.llm.common import table
    sf, size = "/root/testdata/sf0.1", 400
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    base = np.uint64(0x9E3779B97F4A7C15)
    powers = np.ones(size + 1, np.uint64)
    for k in range(1, size + 1):
        powers[k] = powers[k - 1] * base
    hashes = []
    for _, t in texts:
        data = np.frombuffer(t, np.uint8).astype(np.uint64) + np.uint64(1)
        h = np.zeros(max(0, len(t) - size + 1), np.uint64)
        for k in range(size if len(h) else 0):
            h += data[k:k + len(h)] * powers[size - 1 - k]
        hashes.append(h)
    every, inverse, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    twice, at, want = counts[inverse] > 1, 0, []
    for (doc_id, t), h in zip(texts, hashes):
        starts = np.flatnonzero(twice[at:at + len(h)])
        at += len(h)
        edge = np.zeros(len(t) + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, np.minimum(starts + size, len(t)), -1)
        gone = np.cumsum(edge)[:len(t)] > 0
        spans = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        want.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in queries.op9_suffix_dedup(spark, sf).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got) == sorted(want) and sum(w[2] > 0 for w in want) > 100


def test_blocks_do_not_wait_for_long_prefixes(monkeypatch):
    rng = random.Random(5)
    parts = [strings(rng, 600) for _ in range(4)]
    data = np.frombuffer("".join(rng.choice(parts)[rng.randint(0, 300):] for _ in range(40)).encode(), np.uint8)
    at, rounds = A.words(data, 408), []
    order = A.suffix_array(at, len(data))
    same_bytes = A._same_bytes
    monkeypatch.setattr(A, "_same_bytes", lambda a, b: rounds.append(len(a)) or same_bytes(a, b))
    shared = A.common_prefixes(at, order, 400, block=64)
    # A block shares 64 bytes less by its end, so it can gain 400 + 64 at most, a word in a round.
    assert shared.max() == 400 and len(rounds) <= 64 + (400 + 64) / A.WORD + 1


def test_memory_of_a_worker(monkeypatch):
    """A few dozen MB for any table: two workers share an executor with its virtual machine."""
    import tracemalloc

    import pandas as pd
    import pyarrow as pa
    rng = np.random.default_rng(6)
    monkeypatch.setattr(S, "_POWERS", {"up": np.zeros(0, np.uint64), "down": np.zeros(0, np.uint64)})

    def peak(work):
        tracemalloc.start()
        try:
            n = work()
            return n, tracemalloc.get_traced_memory()[1] / 1e6
        finally:
            tracemalloc.stop()

    texts = ["".join(map(chr, rng.integers(97, 123, 2000))) for _ in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array([t[:8].encode() for t in texts]), pa.array(texts)], names=["key", "text"])
    n, mb = peak(lambda: sum(b.num_rows for b in S._item_rows(S.SIZE, S.GRAM)(iter([batch]))))
    assert n > 1500 and mb < 60
    data = [rng.integers(97, 123, 600).astype(np.uint8).tobytes() for _ in range(S.SHARD_BYTES // 600)]
    shard = pd.DataFrame({"h": range(len(data)), "c": range(len(data)), "n": 1, "bytes": [*data[:-1], data[0]]})
    found, mb = peak(lambda: S._sort_shard(S.SIZE, S.CHUNK_BYTES)(shard))
    assert found["h"].tolist() == [0, len(data) - 1] and mb < 90
