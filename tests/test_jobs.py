"""The whole flow: CSV files -> stage -> tables -> documents -> search, twice (second run adds only new rows)."""

from pyspark.sql import functions as F

from mise.operators import search as S
from mise.plans import jobs

POSTS = ("date,num_comments,title,user,comment,n_char\n"
         '2020-01-01,12,Garlic Rice,u1,"Ingredients:\n2 cups rice\n3 cloves garlic, minced\nDirections:\n'
         'Cook the rice in salted water.\nFry the garlic and mix it in.",80\n'
         '2020-01-02,3,Empty,u2,"just chatting about food",20\n')
STRUCTURED = ("title,ingredients,directions,link,source,NER,site\n"
              'Chili,"[""1 lb. beef"", ""2 cans beans (drained)""]","[""Brown the beef in a pot."", '
              '""Simmer with the beans for 1 hour.""]",l,s,n,x\n')


def test_end_to_end(spark, tmp_path):
    (tmp_path / "posts.csv").write_text(POSTS)
    (tmp_path / "structured_rows.csv").write_text(STRUCTURED)
    stage, tables, docs_out = str(tmp_path / "stage"), str(tmp_path / "tables"), str(tmp_path / "docs")
    st1 = {r.entry_number: r.status for r in jobs.extract_to_stage(spark, [str(tmp_path / "posts.csv")], stage).collect()}
    assert st1 == {1: "success", 2: "failed"}
    jobs.extract_to_stage(spark, [str(tmp_path / "structured_rows.csv")], stage, kind="structured")
    out1 = jobs.load_stage_dir(spark, stage, tables)
    assert sorted(r.title for r in out1.collect()) == ["Chili", "Garlic Rice"]
    docs = jobs.export_documents(spark, tables, docs_out)
    chili = docs.filter("title = 'Chili'").first()
    assert [(i.name, i.unit) for i in chili.ingredients] == [("beef", "lb"), ("beans", "cans")]
    hits = docs.filter(S.nested_wildcard("*garlic*")).select("title").collect()
    assert [h.title for h in hits] == ["Garlic Rice"]
    # a second run over the same inputs stages and loads nothing new
    st2 = jobs.extract_to_stage(spark, [str(tmp_path / "posts.csv")], stage)
    assert st2.filter(F.col("status") == "success").count() == 0
    assert jobs.load_stage_dir(spark, stage, tables).count() == 0
    assert jobs.export_documents(spark, tables, str(tmp_path / "docs2")).count() == 2
