import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from mise.llm import filter_audit as A
from tests.llm.conftest import EDGE_ROWS

SCHEMA = "doc_id long, text string, source string, lang string"


def fails(text, doc_id, rows):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    upper = len(re.findall("[A-Z]", text))
    earlier = doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, *_ in rows)
    return (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * upper > 2 * len(text), bool(re.search("[#$%&*|]", text)), earlier)


def brute(rows, labels):
    """Every order walked document by document."""
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, x in labels if x == 1}
    out, parts = [], {}
    for d, t, s, *_ in rows:
        parts.setdefault(s or "", []).append((d, fails(t, d, rows)))
    for part, docs in parts.items():
        total = [0] * 5
        steps = []
        for order in itertools.permutations(range(5)):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[1][f]]
                left = [x for x in left if not x[1][f]]
                total[f] += len(gone)
                steps.append((part, "".join("ABCDE"[i] for i in order), step, f, len(left), len(gone), sum(x[1][f] for x in docs) - len(gone),
                              sum(x[1][f] and sum(x[1]) == 1 for x in docs), sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)))
        out += [(*x[:3], *x[4:], total[x[3]]) for x in steps]
    return sorted(out)


def make_rows(n, seed):
    rng = random.Random(seed)
    texts = [None, "", "a $ b", "WORD " * 250, "same words again " * 90, " ".join(f"w{i}" for i in range(220)), " ".join(f"W{i}" for i in range(220)),
             " ".join(f"w{i} &" for i in range(220)), "x y\tz\x0bq", "é" * 300]
    return [(rng.choice([i, i, None]), rng.choice(texts), rng.choice(["a", "b", "", None]), "en") for i in range(n)]


@pytest.mark.parametrize("rows", [[], make_rows(40, 1), make_rows(6, 2) * 2, [(d, t, "s", "en") for d, t in EDGE_ROWS]])
def test_against_walking_every_order(spark, rows):
    labels = [(1, 1, 0), (1, 0, 0), (2, 0, 1), (5, 1, 1), (7, None, 1), (30, 1, 0)]
    out = A.audit(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = sorted(tuple(r) for r in out.drop("filter").collect())
    assert got == brute(rows, labels)
    assert len(got) == 600 * len({r[2] or "" for r in rows})


def test_walk_visits_every_subset():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 9, (7, 16, 3))
    states = A.gray_walk(counts)
    for active in range(16):
        alive = [m for m in range(16) if not m & active]
        assert (states[:, active] == counts[:, alive].sum(axis=1)).all()


def test_own_filters_and_clashing_names(clashing):
    docs = clashing([(1, "a"), (2, "bb"), (3, None), (4, "bb")]).withColumn("source", F.lit(7)).withColumn("digest", F.lit("x")).withColumn("mask", F.lit("y"))
    out = A.audit_conditions(docs, {"S": F.length("text") < 2, "T": F.col("text") == "bb"})
    rows = {(r["filter_order"], r["step"]): r for r in out.collect()}
    assert len(rows) == 4 and rows["ST", 2]["kept"] == 1 and rows["ST", 1]["removed"] == 1 and rows["TS", 1]["removed"] == 2
    assert {r["part"] for r in rows.values()} == {"7"} and rows["ST", 2]["shapley"] == 4
    with pytest.raises(ValueError):
        A.audit_conditions(docs, {str(i): F.lit(True) for i in range(7)})


def test_two_batches_of_parts(spark, monkeypatch):
    """More parts than one returned batch takes."""
    monkeypatch.setattr(A, "BATCH_ROWS", 1300)
    rows = [(i, "x", f"p{i % 9}", "en") for i in range(30)]
    out = A.audit(spark.createDataFrame(rows, SCHEMA))
    assert out.count() == 9 * 600 and out.where("step = 1 AND filter = 'A'").agg(F.sum("removed")).first()[0] == 30 * 24
