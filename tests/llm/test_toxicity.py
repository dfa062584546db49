import zlib

import numpy as np

from mise.llm import toxicity as X
from tests.llm.conftest import EDGE_ROWS


def out_of_fold(d):
    return zlib.crc32(str(d).encode()) % 5 == 0


def test_features_are_the_n_grams():
    number, found = X.features(["Ab  c", "", "ab c"])
    assert sorted(found[number == 0]) == sorted(found[number == 2]) and len(found[number == 0]) == 4 + 3 + 2
    assert len(found[number == 1]) == 0  # two spaces: too short
    a = set(X.features(["hello world"])[1]) & set(X.features(["hello there"])[1])
    assert len(a) == 5 + 4 + 3  # " hello " in three sizes


def test_logistic_fit_has_no_slope():
    rng = np.random.default_rng(0)
    x = rng.random((200, 6)) < 0.4
    y = (x[:, 0] | (rng.random(200) < 0.2)).astype(float)
    rows, columns = np.nonzero(x)
    w = X.fit_logistic(rows, columns, np.ones(len(rows)), y, 6, steps=300)
    z = x @ w[:-1] + w[-1]
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    error = weight * (1 / (1 + np.exp(-z)) - y)
    assert abs(x.T @ error + X.RIDGE * w[:-1]).max() < 1e-3 and abs(error.sum()) < 1e-3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scores = X.toxicity_scores(docs, X.train(docs, labels))
    rows = scores.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    pos, neg = ([r["score"] for r in rows if r["toxic"] == k] for k in (1, 0))
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.97
    assert np.mean([s >= 0.5 for s in pos]) > 0.85 and np.mean([s >= 0.5 for s in neg]) < 0.03


def test_only_texts_matter_and_held_out_labels_do_not(spark, make):
    rows = [(i, f"you are a {'vile brute' if i % 3 == 0 else 'kind friend'} number {i}") for i in range(120)]
    labels = [(i, 0, int(i % 3 == 0)) for i in range(120)]
    flipped = [(i, q, 1 - t if out_of_fold(i) else t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (X.train(make(rows), spark.createDataFrame(x, schema)) for x in (labels, flipped))
    assert np.allclose(a.weights, b.weights) and np.isclose(a.constant, b.constant)
    got = {r["doc_id"]: r for r in X.toxicity_scores(make(rows), a).collect()}
    assert all(r["held_out"] == out_of_fold(d) and r["predicted"] == (r["score"] >= 0.5) == (d % 3 == 0) for d, r in got.items())


def test_edges(spark, make, clashing):
    schema = "doc_id long, quality int, toxic int"
    none = spark.createDataFrame([], schema)
    model = X.train(make(EDGE_ROWS), none)
    rows = X.toxicity_scores(clashing(EDGE_ROWS), model).collect()
    assert len(rows) == len(EDGE_ROWS) and all(r["score"] < 1e-9 and r["predicted"] == 0 for r in rows)
    ids = [d for d in range(1, 40) if not out_of_fold(d)]
    all_toxic = spark.createDataFrame([(d, 0, 1) for d in ids] + [(None, 0, 1), (ids[0], 0, None), (ids[0], 0, 0)], schema)
    assert X.train(make([(d, "x") for d in ids]), all_toxic).constant > 0
    assert X.toxicity_scores(make([]), model).count() == 0


def test_rows_are_bounded_with_an_id_on_many(spark):
    """One labelled id on 2,000 rows, of equal and of different texts, is one row of the sample."""
    from mise.llm import toxicity as X
    docs = spark.createDataFrame([(1, f"text {i % 500}") for i in range(2000)] + [(i, f"other {i}") for i in range(2, 60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, toxic int")
    rows = X.training_rows(docs, labels, "doc_id", "text", 100).collect()
    ids = [r["k"] for r in rows]
    assert len(ids) == len(set(ids)) <= 100 and 1 in ids
