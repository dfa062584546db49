"""S12, S13, S15, S16, R10 by names and their pieces; S34 from stored prefixes; A3 and A8 inside the extraction job."""

import contextlib
import io

import pytest

from mise.operators import names as NM
from mise.operators import search as S
from mise.operators.relational import ilike_search
from mise.plans import jobs
from mise.sources import staging as ST

NAMES = ["Red Curry Paste", "red wine", "Brown rice", "ÉCLAIR dough", "éclair", "ΟΔΟΣ", "οδοσα", "a", "ab", "abc", "", "50% cream", "x_y", "r*d w", "aaaa", None]
MENTIONS = [(i, n) for i, n in enumerate(NAMES)] + [(i % 5, n) for i, n in enumerate(NAMES)] + [(2, "red wine")]


@pytest.fixture(scope="module")
def tables(spark):
    m = spark.createDataFrame(MENTIONS, "id long, name string")
    names = NM.name_table(m)
    return m, names, NM.gram_table(names)


@pytest.mark.parametrize("pattern", ["*red w*", "*RED*paste", "r?d*", "*a*", "abc", "*ab*", "*", "", "*éclair*", "*ΟΔΟ*", "*zzz*", "*aaa*", "*d wi*ne"])
def test_names_against_the_plain_filter(tables, pattern):
    m, names, pieces = tables
    want = sorted({r["id"] for r in m.where(S.wildcard("name", pattern, True)).collect()})
    assert sorted(r["id"] for r in NM.ids_with_name(m, names, pieces, pattern).collect()) == want


def test_boolean_filter(spark, tables):
    m, names, pieces = tables
    ids = spark.range(20)
    for spec in ("red", ("and", "red", ("or", "wine", "rice"), ("not", "éclair")), ("not", "a"), ("or", "ab", "x_y")):
        assert sorted(map(tuple, NM.ingredient_filter_names(ids, m, names, pieces, spec).collect())) == sorted(map(tuple, S.ingredient_filter_sets(ids, m, spec).collect()))


@pytest.mark.parametrize("term", ["red", "% cr", "_", "ab", "r*d", "ÉCLAIR", "nothing", "b"])
def test_ilike(spark, term):
    df = spark.createDataFrame([(i, n, NAMES[-1 - i]) for i, n in enumerate(NAMES)], "id long, name string, category string")
    tables = {c: (n := NM.name_table(df, c), NM.gram_table(n)) for c in ("name", "category")}
    got = NM.ilike_names(df, term, ["name", "category"], tables)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.select("id").collect())) == sorted(map(tuple, ilike_search(df, term, ["name", "category"]).select("id").collect()))


def test_suggestions(spark, tmp_path):
    titles = ["Thai curry", "thai Basil", "THAI", None, "", "Berry pie", "Therapy"] + [f"Thing {i:03d}" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(titles)), "id long, title string")
    path = str(tmp_path / "s")
    NM.write_suggestions(NM.suggestions(docs), path, 4)
    for prefix in ("t", "Th", "thai", "Thai ", "thing 01", "z", "b"):
        want = [tuple(r) for r in S.suggest(docs, prefix, 7).collect()]
        assert [tuple(r) for r in NM.suggest_stored(spark, path, prefix, 7).collect()] == want
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        NM.suggestions(docs).explain("formatted")
    assert "WindowGroupLimit" in out.getvalue() and "Partial" in out.getvalue()
    for prefix, n in (("", 1), ("x" * 9, 1), ("a", 99)):
        with pytest.raises(ValueError):
            NM.suggest_stored(spark, path, prefix, n)


POSTS = ("date,num_comments,title,user,comment,n_char\n"
         '2020-01-01,12,Garlic Rice,u1,"Ingredients:\n2 cups rice\n3 cloves garlic, minced\nDirections:\nCook the rice in salted water.",80\n')
STRUCTURED = ("title,ingredients,directions,link,source,NER,site\n"
              'Chili,"[""1 lb. beef""]","[""Brown the beef in a pot for ten minutes.""]",l,s,n,x\n')


def test_job_routes_by_name_and_skips_by_ledger(spark, tmp_path):
    (tmp_path / "posts.csv").write_text(POSTS)
    (tmp_path / "Structured_rows.csv").write_text(STRUCTURED)
    paths, stage = [str(tmp_path / "posts.csv"), str(tmp_path / "Structured_rows.csv")], str(tmp_path / "stage")
    first = {(r["dataset"], r["entry_number"]): r["status"] for r in jobs.extract_to_stage(spark, paths, stage).collect()}
    assert first == {("posts.csv", 1): "success", ("Structured_rows.csv", 1): "success"}
    assert {r["recipeData"]["title"] for r in ST.read_stage(spark, stage).collect()} == {"Garlic Rice", "Chili"}
    assert sorted((r["dataset"], r["entryNumber"]) for r in ST.read_ledger(spark, stage).collect()) == [("Structured_rows.csv", 1), ("posts.csv", 1)]
    with open(tmp_path / "posts.csv", "a") as f:
        f.write('2020-01-03,1,Soup,u3,"Ingredients:\n1 cup stock\nDirections:\nBoil the stock for an hour.",9\n')
    again = jobs.extract_to_stage(spark, paths, stage).collect()
    assert [(r["dataset"], r["entry_number"], r["status"]) for r in again] == [("posts.csv", 2, "success")]
    # Nothing of the stage's JSON is read to know what is staged, and of the ledger only the folder named.
    new = spark.createDataFrame([("posts.csv", 1), ("posts.csv", 9)], "dataset string, entry_number long")
    left = ST.skip_staged(new, ST.read_ledger(spark, stage), ["posts.csv"], 1, 2000)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        left.explain("formatted")
    assert "json" not in out.getvalue().lower() and "PartitionFilters: [" in out.getvalue() and "posts.csv" in out.getvalue()
    assert [r["entry_number"] for r in left.collect()] == [9]
    # A stage from before the ledger gets one.
    old = str(tmp_path / "old")
    ST.write_stage(ST.read_stage(spark, stage).select("dataset", "entryNumber", "metadata", "recipeData", "chunk"), old)
    assert jobs.extract_to_stage(spark, paths, old).count() == 0 and ST.read_ledger(spark, old).count() == 3
    with pytest.raises(ValueError):
        jobs.extract_to_stage(spark, [], stage)
