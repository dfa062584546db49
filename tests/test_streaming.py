"""Staged files arriving in several drops load to the same tables as one batch load."""

import json
import os

from pyspark.sql import functions as F

from mise.functions.records import to_dish_rows
from mise.operators import load as L
from mise.sources.staging import read_stage
from mise.streaming import incremental as INC


def _entry(n, title, ings):
    return {"entryNumber": n, "metadata": {"title": title, "num_comments": "3"},
            "recipeData": {"title": title, "ingredients": [{"name": i, "quantity": "1", "unit": "cup"} for i in ings],
                           "instructions": ["Mix everything well together."], "difficulty": "Easy"}}


def _drop(stage, chunk, entries):
    d = os.path.join(stage, "dataset=posts", f"chunk={chunk}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"part-{chunk}.json"), "w") as fh:
        for e in entries:
            fh.write(json.dumps(e) + "\n")
    with open(os.path.join(d, "notes.txt"), "w") as fh:   # ignored: not *.json
        fh.write("not a record")


def _state(spark, base):
    t = INC.read_tables(spark, base)
    r = sorted((x.id, x.title) for x in t.dishes.collect())
    j = sorted((x.dish_id, x.ingredient_id, x.order_index) for x in t.dish_ingredients.collect())
    i = sorted((x.id, x.name) for x in t.ingredients.collect())
    return r, j, i


def test_drops_equal_batch(spark, tmp_path):
    stage, base, ckpt = str(tmp_path / "stage"), str(tmp_path / "tables"), str(tmp_path / "ckpt")
    e1, e2, e3 = _entry(1, "Cake", ["sugar", "flour"]), _entry(2, "Soup", ["salt"]), _entry(3, "Pie", ["flour"])
    _drop(stage, 0, [e1, e2])
    INC.stream_stage(spark, stage, base, ckpt).awaitTermination()
    _drop(stage, 1, [e2, e3])                      # entry 2 again, then a restart of the query
    INC.stream_stage(spark, stage, base, ckpt).awaitTermination()
    INC.stream_stage(spark, stage, base, ckpt).awaitTermination()   # empty drop
    streamed = _state(spark, base)

    batch_base = str(tmp_path / "batch")
    rows = to_dish_rows(read_stage(spark, stage).dropDuplicates(["dataset", "entryNumber"]))
    t, _ = L.load_stage(rows, INC.read_tables(spark, batch_base))
    batch = (sorted((x.id, x.title) for x in t.dishes.collect()),
             sorted((x.dish_id, x.ingredient_id, x.order_index) for x in t.dish_ingredients.collect()),
             sorted((x.id, x.name) for x in t.ingredients.collect()))
    assert streamed == batch
    assert [x[1] for x in streamed[0]] == ["Cake", "Soup", "Pie"]
    outcomes = INC.read_outcomes(spark, base).groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in outcomes} == {"inserted": 3}


def test_recent_counts_batch_form(spark):
    df = spark.createDataFrame([("2024-01-01 00:10:00",), ("2024-01-01 00:50:00",), ("2024-01-01 01:05:00",)],
                               "ts string").select(F.col("ts").cast("timestamp").alias("ts"))
    got = sorted((str(r.window_start), r["count"]) for r in INC.recent_counts(df).collect())
    assert got == [("2024-01-01 00:00:00", 2), ("2024-01-01 01:00:00", 1)]


def test_stream_extract_posts(spark, tmp_path):
    src, out, ck = tmp_path / "csv", str(tmp_path / "out"), str(tmp_path / "ck2")
    src.mkdir()
    (src / "posts1.csv").write_text("date,num_comments,title,user,comment,n_char\n"
                                    '2020-01-01,3,Cake,u,"Ingredients:\n2 cups flour\nSteps:\nMix the flour well.",5\n')
    INC.stream_extract(spark, str(src), out, ck).awaitTermination()
    (src / "posts2.csv").write_text("date,num_comments,title,user,comment,n_char\n"
                                    '2020-01-02,1,Soup,v,"Serves 4\nBoil the water for the soup.",5\n')
    INC.stream_extract(spark, str(src), out, ck).awaitTermination()
    got = {r.title: r for r in spark.read.parquet(out).select("title", "dish.*").collect()}
    assert set(got) == {"Cake", "Soup"}
    assert got["Cake"].ingredients[0].name == "flour" and got["Soup"].servings == "4"


def test_refresh_documents(spark):
    from mise.operators.relational import build_documents
    rec = spark.createDataFrame([(1, "Old", "2024-01-01 00:00:00"), (2, "Keep", "2024-01-01 00:00:00")],
                                "id long, title string, updated_at string").withColumn(
        "updated_at", F.col("updated_at").cast("timestamp"))
    j = spark.createDataFrame([(1, 10, None, None, None, 1)], "dish_id long, ingredient_id long, measurement_id long, "
                                                            "amount decimal(10,3), notes string, order_index int")
    ing = spark.createDataFrame([(10, "salt")], "id long, name string")
    meas = spark.createDataFrame([], "id long, name string")
    t = L.Tables(rec, j, ing, meas)
    docs = build_documents(rec, j, ing, meas)
    rec2 = rec.withColumn("title", F.when(F.col("id") == 1, "New").otherwise(F.col("title"))) \
              .withColumn("updated_at", F.when(F.col("id") == 1, F.lit("2024-02-01").cast("timestamp"))
                          .otherwise(F.col("updated_at")))
    out = INC.refresh_documents(docs, L.Tables(rec2, j, ing, meas), "2024-01-15")
    got = {r.id: (r.title, [i.name for i in r.ingredients]) for r in out.collect()}
    assert got == {1: ("New", ["salt"]), 2: ("Keep", [])}
    assert t.dishes.count() == 2


def test_stream_windows_and_dedupe(spark, tmp_path):
    src = tmp_path / "ev"
    src.mkdir()
    schema = "ts timestamp, dataset string, entryNumber long"
    rows = [("2024-01-01 00:10:00", "d", 1), ("2024-01-01 00:50:00", "d", 2), ("2024-01-01 00:55:00", "d", 2),
            ("2024-01-01 02:30:00", "d", 3)]
    spark.createDataFrame(rows, "ts string, dataset string, entryNumber long") \
         .withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(src / "drop1"))
    q = INC.stream_recent(spark, str(src / "drop1"), schema, str(tmp_path / "windows"), str(tmp_path / "ck5"), "ts",
                          "1 hour", "10 minutes")
    q.awaitTermination()
    got = {str(r.window_start): r["count"] for r in spark.read.parquet(str(tmp_path / "windows")).collect()}
    assert got.get("2024-01-01 00:00:00") == 3
    stream = spark.readStream.schema(schema).parquet(str(src / "drop1"))
    dq = (INC.dedupe_stream(stream, "ts", "1 hour").writeStream.format("memory").queryName("dedup_t4")
             .option("checkpointLocation", str(tmp_path / "ck4")).trigger(availableNow=True).start())
    dq.awaitTermination()
    assert sorted(r.entryNumber for r in spark.sql("SELECT * FROM dedup_t4").collect()) == [1, 2, 3]


def _loaded(spark, base):
    t = INC.read_tables(spark, base)
    names = {x.id: x.name for x in t.ingredients.collect()}
    lines = sorted((x.dish_id, names[x.ingredient_id], x.order_index) for x in t.dish_ingredients.collect())
    outcomes = sorted((o.title, o.status) for o in INC.read_outcomes(spark, base).collect())
    return sorted((x.id, x.title) for x in t.dishes.collect()), lines, sorted(names.values()), outcomes


def _staged(spark, tmp_path, name, entries):
    stage = str(tmp_path / name)
    _drop(stage, 0, entries)
    return read_stage(spark, stage)


def test_replay_after_any_write(spark, tmp_path, monkeypatch):
    rows = _staged(spark, tmp_path, "stage", [_entry(1, "Cake", ["sugar", "flour"]), _entry(2, "Soup", ["salt"])])
    INC.load_batch(rows, 0, str(tmp_path / "clean"))
    want, write = _loaded(spark, str(tmp_path / "clean")), INC.write_rows
    for stop in range(1, 6):
        base, done = str(tmp_path / f"tables{stop}"), []

        def failing(df, path, stop=stop, done=done):
            if len(done) == stop:
                raise OSError("disk")
            done.append(path)
            write(df, path)

        monkeypatch.setattr(INC, "write_rows", failing)
        try:
            INC.load_batch(rows, 0, base)
        except OSError:
            pass
        monkeypatch.setattr(INC, "write_rows", write)
        assert INC.read_tables(spark, base).dishes.count() == 0   # not committed, so not state
        INC.load_batch(rows, 0, base)
        assert _loaded(spark, base) == want
    INC.load_batch(rows, 0, base)                                  # replay of a completed batch
    assert _loaded(spark, base) == want


def test_batch_and_stream_share_a_state(spark, tmp_path):
    base, stage = str(tmp_path / "tables"), str(tmp_path / "drops")
    INC.load_batch(_staged(spark, tmp_path, "first", [_entry(1, "Cake", ["sugar"])]), 0, base)
    _drop(stage, 0, [_entry(2, "Soup", ["salt", "sugar"]), _entry(3, "Cake", ["flour"])])
    INC.stream_stage(spark, stage, base, str(tmp_path / "new-checkpoint")).awaitTermination()
    dishes, lines, names, outcomes = _loaded(spark, base)
    assert dishes == [(1, "Cake"), (2, "Soup")] and names == ["salt", "sugar"]
    assert lines == [(1, "sugar", 1), (2, "salt", 1), (2, "sugar", 2)]
    assert outcomes == [("Cake", "existing"), ("Cake", "inserted"), ("Soup", "inserted")]


def test_bad_values_fail_alone(spark, tmp_path):
    bad = [_entry(1, "t" * 501, ["salt"]), _entry(2, "Long name", ["n" * 201]), _entry(3, "Amount", ["salt"]), _entry(4, "Times", ["salt"]),
           _entry(5, "Good", ["salt"]), _entry(6, "Good", ["salt"]), _entry(7, "Serves", ["salt"]), _entry(8, "Good", ["n" * 201])]
    bad[2]["recipeData"]["ingredients"][0]["quantity"] = "12345678"
    bad[3]["recipeData"]["prepTime"] = "99999999999 min"
    bad[6]["recipeData"]["servings"] = "123456789"
    base = str(tmp_path / "tables")
    INC.load_batch(_staged(spark, tmp_path, "stage", bad), 0, base)
    got = {o.entryNumber: (o.status, o.dish_id, o.error) for o in INC.read_outcomes(spark, base).collect()}
    assert got == {1: ("failed", None, "title too long"), 2: ("failed", None, "ingredient name too long"), 3: ("failed", None, "amount out of range"),
                   4: ("failed", None, "prep_time_minutes out of range"), 5: ("inserted", 1, None), 6: ("existing", 1, None),
                   7: ("failed", None, "servings out of range"), 8: ("existing", 1, None)}
    assert INC.read_tables(spark, base).dishes.count() == 1
