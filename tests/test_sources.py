"""Readers, entry numbering, staging round trip, run status (A1-A17) and R11."""

import os

from pyspark.sql import functions as F

from mise.functions.records import extract_posts
from mise.operators.relational import text_search
from mise.sources import readers as RD
from mise.sources import staging as ST
from mise.sources import status as STS

HEADER = "date,num_comments,title,user,comment,n_char\n"


def test_posts_csv_multiline_and_numbering(spark, tmp_path):
    p = tmp_path / "posts.csv"
    p.write_text(HEADER + '2020-01-01,3,"A ""q"" t",u,"line1\nline2, x",5\n'
                 + '2020-01-02,4,second,v,"one line",8\n' + '2020-01-03,0,third,w,"x\ny\nz",9\n')
    df = RD.read_posts_csv(spark, str(p))
    rows = df.orderBy("entry_number").collect()
    assert [r.title for r in rows] == ['A "q" t', "second", "third"]
    assert rows[0].comment == "line1\nline2, x"
    assert [r.entry_number for r in rows] == [1, 2, 3]
    assert RD.route_by_source(df, "arrays").select("format").distinct().first()[0] == "posts"


def test_numbering_per_file_with_split_blocks(spark, tmp_path):
    d = tmp_path / "many"
    d.mkdir()
    head = "title,ingredients,directions,link,source,NER,site\n"
    big = "arrays_a.csv"
    for name, n in ((big, 3000), ("b.csv", 5)):
        with open(d / name, "w") as fh:
            fh.write(head)
            for i in range(1, n + 1):
                fh.write(f't{i},"[""{i} cup sugar""]","[""Mix well for {i} minutes.""]",l,s,n,x\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")      # force several blocks per file
    try:
        df = RD.read_many(spark, [str(d / big), str(d / "b.csv")], kind="structured")
        got = df.select("dataset", "entry_number", "title").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(r.title == f"t{r.entry_number}" for r in got)
    assert sorted(r.entry_number for r in got if r.dataset == "b.csv") == [1, 2, 3, 4, 5]
    assert len(got) == 3005
    routed = RD.route_by_source(df, "arrays").groupBy("format").count().collect()
    assert {r["format"]: r["count"] for r in routed} == {"structured": 3000, "posts": 5}
    assert RD.select_entries(df, 3, 12).count() == 10 + 3   # entries 3..12 of each file (b.csv has 3..5)


def test_stage_round_trip_and_skip(spark, tmp_path):
    p = tmp_path / "posts.csv"
    p.write_text(HEADER + '2020-01-01,3,Cake,u,"Ingredients:\n2 cups flour\nSteps:\nMix the flour well.",5\n'
                 + '2020-01-02,0,Soup,v,"Serves 4. Boil water for soup.",8\n')
    raw = RD.read_posts_csv(spark, str(p))
    rec = extract_posts(raw, "comment", "title")
    stage = ST.to_stage(rec, {"title": "title", "user": "user", "num_comments": "num_comments"})
    out = str(tmp_path / "stage")
    ST.write_stage(stage, out)
    (tmp_path / "stage" / "README.txt").write_text("ignored")
    back = ST.read_stage(spark, out)
    assert back.count() == 2
    cake = back.filter("entryNumber = 1").first()
    assert cake.recipeData.ingredients[0].name == "flour" and cake.dataset == "posts.csv"
    assert ST.skip_existing(raw, back).count() == 0
    assert sorted(r.entry_number for r in ST.missing_entries(back, 1, 4).collect()) == [3, 4]
    two = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "dataset string, entryNumber long")
    assert sorted(map(tuple, ST.missing_entries(two, 1, 3).collect())) == [("a", 2), ("b", 1), ("b", 3)]
    assert sorted(map(tuple, ST.missing_entries(two, 1).collect())) == [("a", 2), ("b", 1)]
    plan = ST.stage_range(back, 2, 2)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(chunk" in plan
    assert ST.stage_range(back, 2, 2).first().metadata.title == "Soup"
    ST.write_documents(back.select("entryNumber", "recipeData"), str(tmp_path / "docs"))
    assert spark.read.parquet(str(tmp_path / "docs")).count() == 2


def test_status_reports(spark):
    s = spark.createDataFrame([("d", 1, 0, "success", "2024-01-01 00:00:00"), ("d", 2, 0, "failed", "2024-01-01 00:00:05"),
                               ("d", 2, 0, "success", "2024-01-01 00:01:00"), ("d", 3, 0, "failed", "2024-01-01 00:01:01"),
                               ("d", 1001, 1, "existing", "2024-01-01 00:02:00")],
                              "dataset string, entry_number long, chunk long, status string, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    summary = STS.summarise_run(s).first()
    assert (summary.processed, summary.successful, summary.skipped, summary.failed) == (5, 2, 1, 2)
    raw = spark.createDataFrame([("d", 1), ("d", 2), ("d", 3)], "dataset string, entry_number long")
    assert [r.entry_number for r in STS.retry_set(raw, s).collect()] == [3]
    rep = {r.chunk: r for r in STS.chunk_report(s).collect()}
    assert rep[0].entries == 4 and rep[1].processed_so_far == 5
    flagged = STS.with_status(raw, F.col("entry_number") != 2, F.lit("bad"))
    assert [r.status for r in flagged.orderBy("entry_number").collect()] == ["success", "failed", "success"]


def test_text_search_all_terms(spark):
    df = spark.createDataFrame([(1, "Chocolate chip cookies", "Crispy cookies with chocolate"),
                                (2, "Chocolate cake", None), (3, "Oat cookies", "no chocolate here, only oats")],
                               "id long, title string, description string")
    got = [(r.id, r["rank"]) for r in text_search(df, "chocolate cookies", limit=10).collect()]
    # One occurrence weighs 0.1, two 0.1 * (1 + 1/4), scaled by pi^2 / 6.
    assert got == [(1, round(0.1 * 1.25 / 1.64493406685, 9)), (3, round(0.1 / 1.64493406685, 9))]
    # Stems meet: "crisply baked cookie" finds nothing, "chocolates cookie" the same as above.
    assert [r.id for r in text_search(df, "chocolates cookie").collect()] == [1, 3]
    assert text_search(df, "").count() == text_search(df, "the of").count() == 0
    flat = {r.id: r["rank"] for r in text_search(df, "chocolate", normalization=2).collect()}
    assert flat == {1: round(0.1 * 1.25 / 1.64493406685 / 6, 9), 2: round(0.1 / 1.64493406685 / 2, 9), 3: round(0.1 / 1.64493406685 / 6, 9)}


def test_corrupt_rows_become_failed_outcomes(spark, tmp_path):
    p = tmp_path / "rows.csv"
    p.write_text("title,ingredients,directions,link,source,NER,site\n"
                 't1,"[""1 cup sugar""]","[""Mix well together.""]",l,s,n,x\n'
                 't2,"[""2 eggs""]"\n'                                  # too few fields
                 't3,"[""salt""]","[""Season to taste, then serve.""]",l,s,n,x,extra\n')   # too many
    df = RD.read_structured_csv(spark, str(p), keep_corrupt=True).cache()
    st = STS.with_status(df, F.lit(True), F.lit("malformed row"))
    got = {r.title: (r.status, r.error) for r in st.collect()}
    assert got["t1"] == ("success", None)
    assert got["t2"][0] == "failed" and got["t3"][0] == "failed"


def test_same_file_name_in_two_folders(spark, tmp_path):
    for sub in ("a", "b"):
        (tmp_path / sub).mkdir()
        (tmp_path / sub / "posts.csv").write_text(HEADER + f'2020-01-01,1,{sub}1,u,"x",1\n2020-01-01,1,{sub}2,u,"y",1\n')
    df = RD.read_posts_csv(spark, [str(tmp_path / "a" / "posts.csv"), str(tmp_path / "b" / "posts.csv")])
    assert sorted((r.title, r.entry_number) for r in df.collect()) == [("a1", 1), ("a2", 2), ("b1", 1), ("b2", 2)]
