"""Files staged as they come, and loaded; T3 by digests; T5 over batches."""

import datetime as dt

from pyspark.sql import functions as F

from mise.operators.load import Tables
from mise.operators.relational import build_documents
from mise.plans import jobs
from mise.sources import staging as ST
from mise.streaming import incremental as INC

HEAD = "date,num_comments,title,user,comment,n_char\n"


def post(i):
    return f'2020-01-01,{i},Dish {i},u,"Ingredients:\n{i + 1} cups rice\nDirections:\nCook the rice in salted water.",9\n'


def staged(spark, path):
    return sorted((r["dataset"], r["entryNumber"], r["recipeData"]["title"], r["recipeData"]["ingredients"][0]["quantity"])
                  for r in ST.read_stage(spark, path).collect())


def test_drops_restart_and_load_equal_one_batch(spark, tmp_path):
    drop, stage, ckpt = tmp_path / "in", str(tmp_path / "stage"), str(tmp_path / "ckpt")
    drop.mkdir()
    (drop / "a.csv").write_text(HEAD + post(1) + post(2))
    jobs.stream_extract_to_stage(spark, str(drop), stage, ckpt).awaitTermination()
    (drop / "b.csv").write_text(HEAD + post(3))
    (drop / "structured_c.csv").write_text("title,ingredients,directions,link,source,NER,site\n"
                                           'Chili,"[""2 lb. beef""]","[""Brown the beef in a pot for ten minutes.""]",l,s,n,x\n')
    (drop / "notes.txt").write_text("not a table")
    jobs.stream_extract_to_stage(spark, str(drop), stage, ckpt, files_per_batch=1).awaitTermination()
    # A stream that lost its state sees all files again and stages nothing twice.
    jobs.stream_extract_to_stage(spark, str(drop), stage, str(tmp_path / "other")).awaitTermination()
    whole = str(tmp_path / "whole")
    jobs.extract_to_stage(spark, [str(drop / n) for n in ("a.csv", "b.csv", "structured_c.csv")], whole)
    assert staged(spark, stage) == staged(spark, whole) and len(staged(spark, stage)) == 4
    INC.stream_stage(spark, stage, str(tmp_path / "tables"), str(tmp_path / "load")).awaitTermination()
    assert {r["title"] for r in INC.read_tables(spark, str(tmp_path / "tables")).dishes.collect()} == {"Dish 1", "Dish 2", "Dish 3", "Chili"}


def tables(spark, lines, names=("rice", "egg", "salt"), dishes=(1, 2, 3, 4)):
    now = dt.datetime(2024, 1, 1)
    d = spark.createDataFrame([(i, f"dish {i}", now, now) for i in dishes], "id long, title string, created_at timestamp, updated_at timestamp")
    j = spark.createDataFrame([(k, *line) for k, line in enumerate(lines)], "id long, dish_id long, ingredient_id long, measurement_id long, amount double, notes string, order_index int")
    i = spark.createDataFrame([(k + 1, n) for k, n in enumerate(names)], "id long, name string")
    m = spark.createDataFrame([(1, "cup")], "id long, name string")
    return Tables(dishes=d, dish_ingredients=j, ingredients=i, measurements=m)


LINES = [(1, 1, 1, 1.0, None, 1), (1, 2, None, 2.0, None, 2), (2, 1, 1, 3.0, "x", 1), (2, 1, 1, 3.0, "x", 1), (3, 3, None, None, None, 1)]


def docs_of(t):
    return build_documents(t.dishes, t.dish_ingredients, t.ingredients, t.measurements, ("ingredient_id",))


def changed_ids(spark, before, after):
    old = tables(spark, *before)
    docs = docs_of(old).withColumn("built", F.lit("before"))
    new = tables(spark, *after)
    rebuilt, digests = INC.refresh_changed(docs.drop("built"), INC.document_digests(old), new, ("ingredient_id",))
    want = {r["id"]: r for r in docs_of(new).collect()}
    assert {r["id"]: r for r in rebuilt.select(*docs_of(new).columns).collect()} == want
    same = {r["id"] for r in digests.join(INC.document_digests(old), ["id", "lines", "d1", "d2"], "left_semi").collect()}
    return set(want) - same


def test_only_documents_that_changed_are_rebuilt(spark):
    assert changed_ids(spark, (LINES,), (LINES[:1] + LINES[2:],)) == {1}                      # a line taken away
    assert changed_ids(spark, (LINES,), (LINES[:3] + LINES[4:],)) == {2}                      # one of two equal lines
    assert changed_ids(spark, (LINES,), (LINES, ("rice", "eggs", "salt"))) == {1}             # a name
    assert changed_ids(spark, (LINES,), (LINES, ("rice", "egg", "salt"), (1, 2, 4, 5))) == {5}  # a dish gone, one new
    assert changed_ids(spark, (LINES,), (list(reversed(LINES)),)) == set()                    # another order of rows


def test_last_interval_as_the_watermark_passes(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(minutes=7 * i),) for i in range(60)]
    path, schema = str(tmp_path / "in"), "ts timestamp"
    got = {}
    for part in (rows[:25], rows[25:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        INC.stream_last_interval(spark, path, schema, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
        found = spark.read.schema("until timestamp, count long").parquet(str(tmp_path / "out")).collect()
        got = {r["until"]: r["count"] for r in found}
        assert len(got) == len(found)   # each point once
    end = rows[-1][0] - dt.timedelta(minutes=10)
    batch = {r["until"]: r["count"] for r in INC.last_interval_counts(spark.createDataFrame(rows, schema)).collect()}
    assert got == {at: n for at, n in batch.items() if at <= end}
    at = start + dt.timedelta(hours=3)
    assert got[at] == sum(at - dt.timedelta(hours=1) <= r[0] < at for r in rows)
