"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is lower-cased, its white space single spaces, with one at either end; its features are the
distinct n-grams of 3 to 5 characters, hashed to DIMENSIONS.  Over the training rows each feature
has a log ratio of its rate in toxic texts to that in others.  The MOST_FEATURES whose ratios lie
furthest from zero, in standard errors, are kept, and a logistic regression is fitted to them with
the ratios as values.  Both classes weigh the same.

Training takes at most TRAIN_ROWS labelled rows, half of each class at most, chosen by a hash of
the id.  Counts are one vector per partition, joined in one task, and the regression is
fitted on the driver to the kept features of those rows: both are bounded.  Scoring reads every
whole text, in Arrow batches of bounded size, with the weights as a broadcast vector.

Defined results: a null text is empty and gets the classifier's constant; a document without id is
neither held out nor trained on; a document with several labels is toxic if one says so, and null
labels are ignored; without labels of both classes the score is the share of toxic labels (0 if
there are none); repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, arrow_rows

SIZES = (3, 4, 5)
DIMENSIONS = 1 << 20
TRAIN_ROWS, TRAIN_PARTS = 20_000, 8
MOST_FEATURES, LEAST_ERRORS = 4_000, 3.0
RIDGE = 1e-3
BATCH_BYTES = 1_000_000
FOLDS = 5


# -------------------------------------------------------------------------------------- features
def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of every n-gram occurrence."""
    plain = [f" {' '.join(t.lower().split())} " for t in texts]
    sizes = np.array([len(t) for t in plain], np.int64)
    codes = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    of = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))  # characters from here to the text's end
    numbers, found = [], []
    h = codes
    for n in range(1, max(SIZES) + 1):
        if n > 1:
            h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:]
            h = h ^ (h >> np.uint64(29))
        if n in SIZES and len(h):
            inside = left[:len(h)] >= n
            x = (h[inside] + np.uint64(n)) * np.uint64(0xBF58476D1CE4E5B9)
            numbers.append(of[:len(h)][inside])
            found.append(((x >> np.uint64(32)) % np.uint64(DIMENSIONS)).astype(np.int64))
    return (np.concatenate(numbers), np.concatenate(found)) if found else (np.zeros(0, np.int64),) * 2


def distinct_features(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The same without repeats in a text; only features marked in ``wanted`` if given."""
    number, found = features(texts)
    if wanted is not None:
        some = wanted[found]
        number, found = number[some], found[some]
    keys = np.unique(number * DIMENSIONS + found)
    return keys // DIMENSIONS, keys % DIMENSIONS


# -------------------------------------------------------------------------------------- training
@dataclass
class Model:
    weights: np.ndarray  # by feature
    constant: float

    def scores(self, texts: list[str]) -> np.ndarray:
        number, found = distinct_features(texts, self.weights != 0)
        total = np.bincount(number, self.weights[found], len(texts)) + self.constant
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def log_ratios(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> tuple[np.ndarray, np.ndarray]:
    """Log ratio of each feature's rates, and its distance from zero in standard errors."""
    p, q = toxic + 1.0, other + 1.0
    r = np.log(p / (n_toxic + 2)) - np.log(q / (n_other + 2))
    return r, r / np.sqrt(1 / p + 1 / q)


def fit_logistic(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, y: np.ndarray, width: int,
                 steps: int = 80) -> np.ndarray:
    """Weights (the last one the constant) of a ridge logistic regression on a sparse matrix, by L-BFGS."""
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(y)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.bincount(rows, values * w[columns], len(y)) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        error = weight * (p - y)
        ridge = np.append(w[:-1], 0.0) * RIDGE
        value = float(weight @ (np.logaddexp(0, z) - y * z) + 0.5 * ridge @ w)
        return value, np.append(np.bincount(columns, values * error[rows], width), error.sum()) + ridge

    w = np.zeros(width + 1)
    value, grad = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        step, alphas = grad.copy(), []
        for s, g in reversed(past):
            alphas.append(s @ step / (s @ g))
            step -= alphas[-1] * g
        if past:
            step *= past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1])
        for (s, g), a in zip(past, reversed(alphas)):
            step += (a - g @ step / (s @ g)) * s
        size, slope = 1.0, grad @ step
        while size > 1e-8:
            new_value, new_grad = loss(w - size * step)
            if new_value <= value - 1e-4 * size * slope:
                break
            size /= 2
        if size <= 1e-8 or value - new_value < 1e-9:
            break
        past = [*past[-9:], (-size * step, new_grad - grad)]
        w, value, grad = w - size * step, new_value, new_grad
    return w


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for the partition: texts with each feature, by class, as int32 vectors."""
    counts, rows = np.zeros((2, DIMENSIONS), np.int32), np.zeros(2, np.int64)
    for batch in arrow_rows(batches, BATCH_BYTES):
        y = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        number, found = distinct_features(batch.column(1).to_pylist())
        for k in (0, 1):
            counts[k] += np.bincount(found[y[number] == k], minlength=DIMENSIONS).astype(np.int32)
            rows[k] += (y == k).sum()
    yield pa.RecordBatch.from_arrays([pa.array([counts[0].tobytes()]), pa.array([counts[1].tobytes()]), pa.array(rows[:1]), pa.array(rows[1:])],
                                     names=["other", "toxic", "n_other", "n_toxic"])


def _select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each class, and the features kept with their ratios, from the partitions' vectors."""
    counts, rows = np.zeros((2, DIMENSIONS)), np.zeros(2, np.int64)
    for batch in batches:
        for i in range(batch.num_rows):
            for k in (0, 1):
                counts[k] += np.frombuffer(batch.column(k)[i].as_py(), np.int32)
                rows[k] += batch.column(2 + k)[i].as_py()
    ratio, errors = log_ratios(counts[1], counts[0], rows[1], rows[0])
    best = np.argsort(-np.abs(errors), kind="stable")[:MOST_FEATURES]
    best = np.sort(best[np.abs(errors[best]) >= LEAST_ERRORS])
    yield pa.RecordBatch.from_arrays(
        [pa.array(rows[:1]), pa.array(rows[1:]), pa.array([best.astype(np.int32)], pa.list_(pa.int32())),
         pa.array([ratio[best]], pa.list_(pa.float64()))], names=["n_other", "n_toxic", "feature", "ratio"])


def _picker(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, BATCH_BYTES):
            number, found = distinct_features(batch.column(1).to_pylist(), wanted.value)
            offsets = np.searchsorted(number, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, found.astype(np.int32))],
                                             names=["y", "found"])

    return run


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """(k, y, t) of at most about ``most`` labelled ids that aren't held out, one text each: of an id with several
    the one with the least hash, so that an id on many rows is one of them."""
    known = labels.select(F.col(id_col).alias("k"), F.col("toxic").alias("y")).where("k is not null and y is not null")
    scratch = Scratch(docs.sparkSession)
    known = scratch.table(known.where(~held_out("k")).groupBy("k").agg(F.max("y").cast("int").alias("y")))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    scale = 1_000_000
    share = F.lit(0)
    for y, n in sizes.items():
        share = F.when(F.col("y") == y, int(scale * min(1.0, most / 2 / n))).otherwise(share)
    chosen = scratch.table(known.where(F.pmod(F.xxhash64("k", F.lit(6)), F.lit(scale)) < share))
    # At most about ``most`` pairs of id and label: small enough to send to every executor.
    rows = docs.join(F.broadcast(chosen), docs[id_col] == chosen["k"])
    rows = rows.select("k", "y", F.coalesce(docs[text_col], F.lit("")).alias("t"))
    one = rows.groupBy("k", "y").agg(F.min(F.struct(F.xxhash64("t"), F.col("t"))).alias("one"))
    return one.select("k", "y", "one.t")


def held_out(column: str) -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_ROWS) -> Model:
    spark = docs.sparkSession
    rows = Scratch(spark).table(training_rows(docs, labels, id_col, text_col, most).repartition(TRAIN_PARTS, "k", "t").select("y", "t"))
    # One vector for each of TRAIN_PARTS partitions meets in one task, which returns what it keeps.
    vectors = rows.mapInArrow(_counter, "other binary, toxic binary, n_other long, n_toxic long")
    best = vectors.repartition(1).mapInArrow(_select, "n_other long, n_toxic long, feature array<int>, ratio array<double>").first()
    if best is None or not best["n_other"] or not best["n_toxic"]:
        return Model(np.zeros(DIMENSIONS), 500.0 if best and best["n_toxic"] else -500.0)
    wanted, ratio = np.zeros(DIMENSIONS, bool), np.zeros(DIMENSIONS, np.float32)
    wanted[best["feature"]] = True
    ratio[best["feature"]] = best["ratio"]
    picked = rows.mapInArrow(_picker(spark.sparkContext.broadcast(wanted)), "y int, found array<int>").toArrow()
    y = picked.column("y").to_numpy().astype(float)
    lists = picked.column("found").combine_chunks()
    row = np.repeat(np.arange(len(y), dtype=np.int32), lists.value_lengths().to_numpy(zero_copy_only=False))
    found = lists.flatten().to_numpy()
    del picked, lists
    kept = np.flatnonzero(wanted)
    place = np.zeros(DIMENSIONS, np.int32)
    place[kept] = np.arange(len(kept))
    w = fit_logistic(row, place[found], ratio[found], y, len(kept))
    weights = np.zeros(DIMENSIONS)
    weights[kept] = w[:-1] * ratio[kept]
    return Model(weights, float(w[-1]))


# --------------------------------------------------------------------------------------- scoring
def toxicity_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score and predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, BATCH_BYTES):
            scores = sent.value.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    kind = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, kind).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
