"""Hot keys: one ingredient, one cuisine and one title each hold a third of the rows.
Results are checked against a brute-force pandas computation on the same rows."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from mise.operators import aggregates as G
from mise.operators import load as L
from mise.operators import search as S


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    names = ["salt", "red pepper", "green pepper", "rice", "olive oil", "garlic", "onion", "sugar"]
    rows = []
    for i in range(6000):
        dish = i // 4
        name = "salt" if i % 3 == 0 else rnd.choice(names[1:])
        rows.append((dish, name))
    mentions = pd.DataFrame(rows, columns=["id", "name"])
    dishes = pd.DataFrame({"id": range(1500)})
    dishes["cuisine_type"] = ["hot" if k % 3 == 0 else f"c{k % 7}" for k in dishes.id]
    dishes["title"] = ["same" if k % 3 == 0 else f"t{k}" for k in dishes.id]
    m = mentions.merge(dishes, on="id")
    return (spark.createDataFrame(m[["id", "cuisine_type", "name"]]), spark.createDataFrame(dishes), m, dishes)


def test_top_per_group_under_skew(skewed):
    flat, dishes, m, _ = skewed
    got = {(r.cuisine_type, r.name): (r["count"], r["rank"])
           for r in G.top_per_group(dishes, "cuisine_type", 3, 2, flat=flat).collect()}
    groups = (skewed[3].groupby("cuisine_type").size().reset_index(name="n")
              .sort_values(["n", "cuisine_type"], ascending=[False, True]).head(3).cuisine_type)
    want = {}
    for g in groups:
        c = m[m.cuisine_type == g].groupby("name").size().reset_index(name="n")
        c = c.sort_values(["n", "name"], ascending=[False, True]).head(2)
        for k, (name, n) in enumerate(zip(c.name, c.n), 1):
            want[(g, name)] = (n, k)
    assert got == want


def test_dedupe_under_skew(spark, skewed):
    dishes = skewed[1].withColumnRenamed("id", "entryNumber").withColumn("dataset", F.lit("d"))
    first = L.first_per_key(dishes, "title", ["dataset", "entryNumber"])
    dups = L.duplicates_of_first(dishes, "title", ["dataset", "entryNumber"])
    r = skewed[3]
    assert first.count() == r.title.nunique() and dups.count() == len(r) - r.title.nunique()
    assert first.filter("title = 'same'").first().entryNumber == 0


def test_frequency_and_nested_scores_under_skew(skewed):
    flat, dishes, m, _ = skewed
    f = {r.name: (r.mentions, r.dishes) for r in G.ingredient_frequency(dishes, 10, flat=flat).collect()}
    assert f["salt"] == (int((m.name == "salt").sum()), int(m[m.name == "salt"].id.nunique()))
    scores = {r.id: r.score for r in S.nested_scores_flat(flat.select("id", "name"), "pepper").collect()}
    # brute force BM25 over entries: every entry is one name
    toks = {n: n.split() for n in m.name.unique()}
    n_entries = len(m)
    avgdl = sum(len(toks[n]) for n in m.name) / n_entries
    df_ = sum(1 for n in m.name if "pepper" in toks[n])
    idf = math.log(1 + (n_entries - df_ + 0.5) / (df_ + 0.5))
    want = {}
    for rid, n in zip(m.id, m.name):
        tf = toks[n].count("pepper")
        if tf:
            want[rid] = want.get(rid, 0.0) + idf * tf / (tf + 1.2 * (0.25 + 0.75 * len(toks[n]) / avgdl))
    assert set(scores) == set(want) and all(abs(scores[k] - want[k]) < 1e-9 for k in want)
