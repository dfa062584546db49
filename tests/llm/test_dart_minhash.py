import random

import numpy as np
import pytest

from mise.llm import dart_minhash as M
from mise.llm.common import Scratch
from mise.llm.components import connected_components
from tests.llm.conftest import EDGE_ROWS


def weights(text, kind):
    w = (text or "").lower().split()
    grams = [" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []
    return {g: (grams.count(g) if kind == "count" else 1) for g in grams}


def similarity(a, b):
    both = sum(min(n, b.get(g, 0)) for g, n in a.items())
    return both / (sum(a.values()) + sum(b.values()) - both) if a or b else 1.0


def brute(rows, kind="set", threshold=0.8):
    sets = [weights(t, kind) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= threshold - 1e-9:
                label[root(i)] = root(j)
    classes = {}
    for i, (d, _) in enumerate(rows):
        classes.setdefault(root(i), []).append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in classes.items()}
    return sorted(((d, least[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


def prose(rng, n):
    return " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 9) + str(rng.randint(0, 30)) for _ in range(n))


def changed(rng, text, n):
    w = text.split()
    for k in rng.sample(range(len(w)), n):
        w[k] = "changed" + str(rng.randint(0, 10**9))
    return " ".join(w)


@pytest.mark.parametrize("kind", ["set", "count"])
def test_agreement_is_weighted_similarity(kind):
    rng = np.random.default_rng(7)
    for share in (0.3, 0.6, 0.9):
        got, want = [], []
        for _ in range(12):
            a = np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64))
            b = np.sort(np.where(rng.random(len(a)) < share, a, rng.integers(0, 1 << 63, len(a)).astype(np.uint64)))
            draw = lambda x: rng.integers(1, 9, len(x)) * 0.75 if kind == "count" else np.ones(len(x))
            wa, wb = draw(a), draw(b)
            got.append(np.mean(M.signature(a, wa, 256) == M.signature(b, wb, 256)))
            want.append(similarity(dict(zip(a.tolist(), wa)), dict(zip(b.tolist(), wb))))
        assert abs(np.mean(got) - np.mean(want)) < 0.025


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(12)] + [(100, i) for i in range(101, 160)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    label = {}

    def root(x):
        label.setdefault(x, x)
        return x if label[x] == x else root(label[x])

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            label[y] = x
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    assert got == {x: root(x) for x in label}
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


def classes(df):
    return sorted(((r["doc_id"], r["class_id"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("kind", ["set", "count"])
def test_classes_are_those_of_all_pairs(make, kind):
    rng = random.Random(11)
    rows = [(i, prose(rng, rng.randint(30, 120))) for i in range(40)]
    for i in range(0, 20):
        base = rows[i][1]
        rows += [(100 + 10 * i + k, changed(rng, base, rng.randint(0, 4))) for k in range(rng.randint(0, 5))]
    hot = prose(rng, 100)
    rows += [(1000 + k, changed(rng, hot, 2)) for k in range(60)] + [(2000 + k, hot) for k in range(30)]
    rows += [(3000 + k, "tiny text") for k in range(3)] + [(3100, "tiny  TEXT"), (3200, "tiny texts")] + [(4000, "again " * 60), (4001, "again " * 80)]
    assert classes(M.near_duplicates(make(rows), M.Settings(weights=kind))) == brute(rows, kind)


def test_remaining_pairs_find_what_leaders_miss(make):
    rng = random.Random(12)
    chain = [prose(rng, 80)]
    for _ in range(40):
        chain.append(changed(rng, chain[-1], 1))  # neighbours are near, the ends aren't
    rows = list(enumerate(chain))
    assert len({c for _, c in brute(rows)}) == 1
    assert classes(M.near_duplicates(make(rows), M.Settings(rounds=0))) == brute(rows)


def test_large_buckets_go_by_blocks(make):
    rng = random.Random(14)
    hot = prose(rng, 100)
    rows = [(k, changed(rng, hot, rng.randint(0, 9))) for k in range(70)]  # many pairs around the threshold
    want = brute(rows)
    assert 1 < len({c for _, c in want}) < 60
    assert classes(M.near_duplicates(make(rows), M.Settings(rounds=0, small=4, block=8))) == want
    assert classes(M.near_duplicates(make(rows))) == want


def test_clean_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert classes(M.near_duplicates(docs)) == brute(rows)


def test_edges(make, clashing):
    assert M.near_duplicates(make([])).count() == 0
    assert classes(M.near_duplicates(clashing(EDGE_ROWS))) == brute(EDGE_ROWS)


def test_filter_keeps_one_of_each(clashing):
    rng = random.Random(13)
    base = prose(rng, 60)
    rows = [(1, base), (2, base), (3, changed(rng, base, 1)), (3, changed(rng, base, 1)), (4, prose(rng, 50)), (4, prose(rng, 50)), (5, base), (None, prose(rng, 40))]
    rows += [(6, x := prose(rng, 30)), (6, x), (7, None), (8, "")]
    docs = clashing(rows)
    out = M.drop_near_duplicates(docs)
    assert out.schema == docs.schema
    kept = sorted((str(r["doc_id"]) for r in out.collect()))
    assert kept == sorted(["1", "4", "4", "None", "6", "7"])
    assert M.drop_near_duplicates(clashing([])).count() == 0
