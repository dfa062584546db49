"""The stored index of the dishes: documents are built once, and nothing that outnumbers documents and terms is shuffled."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from mise.operators import index as IX
from mise.operators import relational as R
from mise.plans import bindings as B
from mise.plans import queries_search as Q


def star(spark, path, parts, suppliers):
    orders = [(o, "F" if o % 3 else "O", f"{o % 4}-P") for o in range(60)] + [(7, "F", "3-P"), (71, None, "0-P"), (None, None, None), (70, "O", None)]
    lines = [(o, (o * 7 + k) % 12, k % 5, k // 2, float(o * k % 7), float(9 - k)) for o in range(60) for k in range(5)]
    lines += [(None, 1, 1, 1, 1.0, 1.0), (5, None, None, 1, 1.0, 1.0), (9, 3, None, None, None, None), (9, 3, 4, 1, 2.0, 1.0), (9, 3, 1, 1, 2.0, 1.0), (999, 3, 1, 1, 1.0, 1.0)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string, o_orderpriority string").withColumns({
        "o_totalprice": F.lit(1000.0), "o_custkey": F.lit(1), "o_orderdate": F.lit("2020-01-01").cast("timestamp")}).write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double").withColumn(
        "l_returnflag", F.lit("N")).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_name string").withColumns({"p_type": F.lit("t"), "p_brand": F.lit("b")}).write.parquet(f"{path}/part.parquet")
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{path}/supplier.parquet")
    return str(path)


PARTS = [(p, None if p == 4 else ("small gear", "hot widget", "Widget widgets hot")[p % 3] + f" {p}") for p in range(12)] + [(None, "none")]
SUPPLIERS = [(s, f"s{s}", 1) for s in range(3)] + [(None, "none", 1)]


#: Ids that come twice, with other names.
MORE_PARTS, MORE_SUPPLIERS = [(3, "a first"), (3, "a first"), (5, "z last")], [(1, "other", 2)]


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("again", [0, 1])
def test_documents_of_names_hold_the_names_of_the_documents(spark, tmp_path, again):
    tables = star(spark, tmp_path, PARTS + MORE_PARTS * again, SUPPLIERS + MORE_SUPPLIERS * again)
    cols = ["id", "title", "difficulty", "cuisine_type"]
    whole = B.documents(spark, tables).select(*cols, F.col("ingredients")["name"].alias("n"))
    narrow = B.documents(spark, tables, parts=["name"])
    assert narrow.schema["ingredients"].dataType.simpleString() == "array<struct<name:string>>"
    narrow = narrow.select(*cols, F.col("ingredients")["name"].alias("n"))
    assert sorted(narrow.collect(), key=str) == sorted(whole.collect(), key=str)
    assert max(len(r["n"]) for r in whole.collect()) >= 7


def test_what_is_not_read_is_not_shuffled_if_ids_come_once(spark, tmp_path):
    plan = optimized(B.documents(spark, star(spark, tmp_path, PARTS, SUPPLIERS), parts=["name"]))
    shuffled = [line for line in plan.split("\n") if "Relation" not in line]
    assert not any("l_extendedprice" in line or "l_quantity" in line for line in shuffled) and "s_name" not in plan


@pytest.mark.parametrize("again,name", [(0, "stored_nested_match"), (1, "stored_multi_match_all_fields")])
def test_dishes_are_built_once_and_postings_are_not_shuffled(spark, tmp_path, monkeypatch, again, name):
    tables = star(spark, tmp_path, PARTS + MORE_PARTS * again, SUPPLIERS + MORE_SUPPLIERS * again)
    written, given, built = [], [], []
    save, add, nest = IX._save, IX.StoredIndex.add, R.nest_dishes
    monkeypatch.setattr(Q, "_STORED", {})
    monkeypatch.setattr(R, "nest_dishes", lambda *a: built.append(1) or nest(*a))
    monkeypatch.setattr(IX, "_save", lambda rows, path: written.append((path, optimized(rows))) or save(rows, path))
    monkeypatch.setattr(IX.StoredIndex, "add", lambda self, docs, batch, key="id": given.append(optimized(docs)) or add(self, docs, batch, key))
    got = E.queries()[name](spark, tables).collect()
    # The index's documents are built once; the query's own dishes are not nested, as only their ids are read.
    assert len(built) == (1 if name == "stored_nested_match" else 2) and len(given) == 2 and not any("l_orderkey" in p for p in given)
    kinds = [(p.split("/")[-2], "Rebalance" in plan) for p, plan in written]
    assert kinds == [("postings", False), ("terms", True), ("neighbourhoods", False)] * 2
    docs = B.documents(spark, tables)
    live = IX.DocumentIndex(docs, Q.DISH_FIELDS)
    index = Q.stored_dishes(spark, tables)
    assert len(given) == 2

    def scores(source, text):
        return sorted((str(r["id"]), r["field"], round(r["score"], 9)) for r in IX.field_scores(source, text, Q.DISH_BOOSTS).collect())

    for text in ("widget hot", "3-P"):
        assert scores(live, text) == scores(index, text)
    assert got and scores(live, "widget hot")


def test_a_neighbourhood_is_one_row_of_its_term(spark, tmp_path):
    index = IX.create_index(spark, f"{tmp_path}/i", [IX.text_field("t")], buckets=4)
    index.add(spark.createDataFrame([(1, "order 12345678"), (2, "order 12345687 a"), (3, "ab ordr")], "id long, t string"), "one")
    rows = spark.read.parquet(f"{tmp_path}/i/neighbourhoods/batch=one").where("term != ''")
    assert sorted(r["term"] for r in rows.collect()) == ["12345678", "12345687", "ab", "order", "ordr"]
    assert rows.select("bucket", F.substring("term", 1, 2)).distinct().count() == 3  # one bucket for a prefix
    found, answer = index.lookup_fuzzy(IX.query_terms(index, "ordre 1234568", {"t": 1.0}))
    assert sorted((r["qterm"], r["term"]) for r in found.collect()) == [("1234568", "12345678"), ("1234568", "12345687"), ("ordre", "order"), ("ordre", "ordr")]
    assert sorted(r["id"] for r in answer.postings.collect()) == [1, 1, 2, 2, 3]
