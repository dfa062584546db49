"""S2 with S3, S6, S26, S27, S30, S35: one index over text, exact and nested fields, stored or from the documents."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from mise.functions.analysis import english, english_porter, ingredient_analyzer, token_spans
from mise.operators import fuzzy as FZ
from mise.operators import index as IX
from mise.operators import search as S

FIELDS = (IX.text_field("title"), IX.text_field("description"), IX.keyword_field("cuisine_type"), IX.keyword_field("tags"),
          IX.nested_field("ingredients", "name"), IX.nested_field("ingredients", "name", None, "ingredients.name.keyword"))
DOCS = [(1, "Spicy thai curry", "A curry with rice and the heat of chillies", "Thai", ["hot"], ["red curry paste", "rice", None]),
        (2, "Cookies", "Chocolate cookie dough, cookies for all", "thai curry", ["sweet", "quick"], ["chocolate", "flour"]),
        (3, "Berry pie", None, None, None, None), (4, None, "", "Italian", [], []), (5, "Thai", "curry curry curry", "Thai", ["hot", None], ["rice", "rice noodles"]),
        (6, "Carbonara spaghetti", "pasta", "Italian", ["quick"], ["spaghetti", "eggs"])]
SCHEMA = "id long, title string, description string, cuisine_type string, tags array<string>, ingredients array<struct<name:string>>"
BOOSTS = {"title": 5.0, "description": 2.0, "cuisine_type": 3.0, "tags": 1.0, "ingredients.name": 1.0, "ingredients.name.keyword": 2.0}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r[:5], None if r[5] is None else [(n,) for n in r[5]]) for r in DOCS], SCHEMA)


@pytest.fixture(scope="module")
def stored(spark, docs, tmp_path_factory):
    index = IX.create_index(spark, str(tmp_path_factory.mktemp("index") / "i"), FIELDS, buckets=4)
    index.add(docs.where("id <= 2"), "a")
    index.add(docs.where("id > 2"), "b")
    return index


def rows(df):
    return [(r["id"], round(r["score"], 9)) for r in df.select("id", "score").collect()]


@pytest.mark.parametrize("text,mode", [("thai curry", "sum"), ("red curry paste hot cookies", "avg"), ("rice", "max"), ("the", "sum")])
def test_stored_and_documents_agree(docs, stored, text, mode):
    live = IX.DocumentIndex(docs, FIELDS)
    a, b = (sorted((r["id"], r["field"], round(r["score"], 9)) for r in IX.field_scores(i, text, BOOSTS, mode).collect()) for i in (live, stored))
    assert a == b


def test_kinds_of_fields(docs, stored):
    found = {(r["id"], r["field"]) for r in IX.field_scores(stored, "thai curry", BOOSTS).collect()}
    assert found == {(1, "title"), (1, "description"), (2, "cuisine_type"), (5, "title"), (5, "description"), (1, "ingredients.name")}
    assert {(r["id"], r["field"]) for r in IX.field_scores(stored, "rice", BOOSTS).collect()} >= {(1, "ingredients.name.keyword"), (5, "ingredients.name")}
    assert {r["id"] for r in IX.field_scores(stored, "hot", {"tags": 1.0}).collect()} == {1, 5}
    # Exact values have no length norm: ln(1 + (N - df + 0.5) / (df + 0.5)) / 2.2.
    import math
    r, = IX.field_scores(stored, "thai curry", {"cuisine_type": 3.0}).collect()
    assert r["score"] == pytest.approx(3 * math.log(1 + 4.5 / 1.5) / 2.2)


def test_operators_from_both_sources(docs, stored):
    live = IX.DocumentIndex(docs, FIELDS)
    index = stored
    assert [r[0] for r in rows(S.multi_match(docs, "thai curry", BOOSTS, 0.3, index=index))] == [r[0] for r in rows(S.multi_match(docs, "thai curry", BOOSTS, 0.3, index=live))]
    assert rows(S.match(docs, "description", "curry", index=index)) == rows(S.match(docs, "description", "curry"))
    assert rows(S.nested_match(docs, "rice", index=index)) == rows(S.nested_match(docs, "rice"))
    assert rows(S.any_of_ingredients(docs, ["eggs", "flour"], index=index)) == rows(S.any_of_ingredients(docs, ["eggs", "flour"]))
    assert rows(S.search(docs, "curry", {"cuisine_type": "Thai"}, index=index)) == rows(S.search(docs, "curry", {"cuisine_type": "Thai"}))
    assert rows(S.any_field(docs, "Italian pasta", keyword_fields=("cuisine_type",), index=index)) == rows(S.any_field(docs, "Italian pasta", keyword_fields=("cuisine_type",)))
    assert rows(S.more_like(docs, 1, ["title", "description"], min_doc_freq=1, index=index)) == rows(S.more_like(docs, 1, ["title", "description"], min_doc_freq=1))
    assert rows(S.fuzzy_match(docs, "spagetti chocolat", {"title": 3.0, "description": 1.0}, index=index)) == rows(
        S.fuzzy_match(docs, "spagetti chocolat", {"title": 3.0, "description": 1.0}))
    assert [r[0] for r in rows(S.fuzzy_match(docs, "spagetti", {"title": 3.0}, index=stored))] == [6]
    assert 5 in [r[0] for r in rows(S.more_like(docs, 1, ["title", "ingredients.name"], min_doc_freq=1, index=stored))]


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_stored_queries_read_no_text_and_prune_buckets(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/docs")
    table = spark.read.parquet(f"{tmp_path}/docs")
    index = IX.create_index(spark, f"{tmp_path}/i", FIELDS, buckets=4)
    index.add(table, "all")
    scores = plan(IX.field_scores(index, "curry rice", {"title": 1.0, "description": 1.0}))
    assert f"{tmp_path}/docs" not in scores and "PartitionFilters" in scores and "bucket" in scores
    assert plan(S.multi_match(table, "curry", {"title": 1.0}, index=index).select("id", "score")).count("description:string") == 0
    expansions, found = index.lookup_fuzzy(IX.query_terms(index, "curri", {"title": 1.0}))
    assert f"{tmp_path}/docs" not in plan(found.postings.join(expansions, ["field", "term"]))


def test_a_batch_given_again_replaces_and_a_lost_one_does_not_count(spark, docs, stored, tmp_path):
    index = IX.create_index(spark, f"{tmp_path}/i", FIELDS, buckets=4)
    index.add(docs.where("id = 6"), "a")
    index.add(docs.where("id <= 2"), "a")
    index.add(docs.where("id > 2"), "b")
    want = sorted(map(tuple, stored.frequencies().collect()))
    assert sorted(map(tuple, index.frequencies().collect())) == want
    # What a load leaves that stops before its last file.
    IX._write(IX.index_rows(docs, FIELDS).withColumn("bucket", F.lit(0)), f"{tmp_path}/i/postings/batch=lost")
    assert sorted(map(tuple, index.frequencies().collect())) == want and index.batches() == ["a", "b"]
    assert rows(S.match(docs, "title", "thai", index=index)) == rows(S.match(docs, "title", "thai"))
    with pytest.raises(ValueError):
        IX.StoredIndex(spark, f"{tmp_path}/i", FIELDS[:2])


def edits(a, b):
    """Edit distance with swaps as one edit, by its definition over prefixes (characters between a swap may be edited)."""
    last, d = {}, {(-1, -1): len(a) + len(b)}
    for i in range(len(a) + 1):
        d[i, -1], d[i, 0] = len(a) + len(b), i
    for j in range(len(b) + 1):
        d[-1, j], d[0, j] = len(a) + len(b), j
    for i in range(1, len(a) + 1):
        db = 0
        for j in range(1, len(b) + 1):
            k, m = last.get(b[j - 1], 0), db
            cost = 1
            if a[i - 1] == b[j - 1]:
                cost, db = 0, j
            d[i, j] = min(d[i - 1, j - 1] + cost, d[i, j - 1] + 1, d[i - 1, j] + 1, d[k - 1, m - 1] + (i - k - 1) + 1 + (j - m - 1))
        last[a[i - 1]] = i
    return d[len(a), len(b)]


def test_neighbourhoods_against_all_pairs(spark, tmp_path):
    import random
    rng = random.Random(3)
    words = sorted({"ab" + "".join(rng.choice("abc") for _ in range(rng.randint(0, 6))) for _ in range(160)} | {"a", "ab", "abcdef", "abdcef", "abéü"})
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id long, title string")
    field = IX.text_field("title", lambda c: F.split(c, " "))
    index = IX.create_index(spark, f"{tmp_path}/i", [field], buckets=4)
    index.add(docs, "a")
    queries = ["abcabc", "ab", "abc", "abdcfe", "abbacc", "abéü", "abu", "abcbaccb"]
    query = IX.query_terms(index, " ".join(queries), {"title": 1.0})
    want = {(q, w) for q in queries for w in words if q[:2] == w[:2] and edits(q, w) <= (0 if len(q) <= 2 else 1 if len(q) <= 5 else 2)}
    for source in (index, IX.DocumentIndex(docs, [field])):
        got = {(r["qterm"], r["term"]) for r in source.lookup_fuzzy(query)[0].collect()}
        assert got == want
    assert len(want) > 60
    with pytest.raises(ValueError):
        index.lookup_fuzzy(query, 1)


def test_token_spans_and_highlight(spark, docs):
    text = "Éclairs, and COOKIES: the cookie's crumbs " + "x " * 700
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "id long, t string")
    got = {r["id"]: r["s"] for r in df.select("id", token_spans("t", english).alias("s")).collect()}
    terms = df.select("id", english(F.col("t")).alias("t")).where("id = 1").first()["t"]
    assert [s["term"] for s in got[1]] == terms and got[2] == [] and not got[3]
    assert [text[s["start"]:s["end"]] for s in got[1][:4]] == ["Éclairs", "COOKIES", "cookie", "s"]
    assert all(text[s["start"]:s["end"]] == "x" for s in got[1][5:])
    out = {r["id"]: r for r in S.highlight_match(docs, ["title", "description"], "the cookies of berries", english_porter).collect()}
    assert out[2]["title_highlight"] == "<em>Cookies</em>"
    assert out[2]["description_highlight"] == "Chocolate <em>cookie</em> dough, <em>cookies</em> for all"
    assert out[3]["title_highlight"] == "<em>Berry</em> pie" and out[3]["description_highlight"] is None
    assert out[1]["description_highlight"] == DOCS[0][2] and out[4]["description_highlight"] == ""
    plain = S.highlight_match(docs, ["title"], "cookies", ingredient_analyzer).where("id = 2").first()
    assert plain["title_highlight"] == "<em>Cookies</em>"


def test_neighbourhood_of_short_terms(spark):
    r = spark.range(1).select(FZ.neighbourhood(F.lit("a"), 2).alias("a"), FZ.neighbourhood(F.lit("abc"), 2).alias("b")).first()
    assert r["a"] == ["a"] and r["b"] == ["abc", "ab"]
