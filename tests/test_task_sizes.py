"""What one task gets: it must not grow with the table, nor with the rows of one title."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from mise import schemas as SCH
from mise.operators import aggregates as G
from mise.operators import keys
from mise.operators import load as L
from mise.plans import bindings as B


@pytest.fixture()
def star(spark, tmp_path):
    lines = [(o, (o * 7 + k) % 40, k) for o in range(3000) for k in range(4)] + [(None, 1, 1), (5, None, 1), (9999, 3, 1)]
    orders = [(o, 1000.0) for o in range(3000)] + [(7, 1000.0), (None, 1.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int").withColumns({
        "l_suppkey": F.lit(1), "l_quantity": F.lit(1.0), "l_returnflag": F.lit("N"), "l_extendedprice": F.lit(1.0)}).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_totalprice double").withColumns({
        "o_orderstatus": F.lit("F"), "o_orderpriority": F.lit("1-URGENT"), "o_custkey": F.lit(1),
        "o_orderdate": F.lit("2020-01-01").cast("timestamp")}).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(p, f"n{p % 8}", "t", "b") for p in range(40)], "p_partkey long, p_name string, p_type string, p_brand string").write.parquet(
        f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_mentions_by_dish_are_dealt_by_rows(spark, star, monkeypatch):
    monkeypatch.setattr(keys, "ROWS_PER_TASK", 500)
    m = B.mentions(spark, star, ("title",), by_dish=True)
    sizes = [r["count"] for r in m.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1500 and sum(sizes) == 12004  # order 7 is there twice; lines without dish or part aren't
    plain = B.mentions(spark, star, ("title",))
    assert sorted(m.collect(), key=str) == sorted(plain.collect(), key=str)
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        E.queries()["top_ingredients_with_titles"](spark, star).explain()
    assert "REPARTITION_BY_NUM" in plan.getvalue()
    want = G.top_with_samples(B.dishes(spark, star), 50, 3, flat=plain)
    want = want.select("name", "mentions", "dishes", F.array_join("titles", "|").alias("titles"))
    assert sorted(E.queries()["top_ingredients_with_titles"](spark, star).collect()) == sorted(want.collect())


def _indent(line: str) -> int:
    return next((i for i, c in enumerate(line) if c.isalpha() or c == "*"), len(line))


def test_rows_of_a_title_are_limited_before_they_are_dealt_out(spark, monkeypatch):
    schema = "dataset string, entryNumber long, title string, ingredients array<struct<name:string,unit:string,amount:double,notes:string,order_index:int>>"
    rows = [("d", i, f"t{i % 3}" if i % 5 else None, [(f"n{i % 4}", "cup", 1.0, None, 1)]) for i in range(60)]
    rows += [("d", 3, "t0", []), ("d", None, "t9", []), (None, None, "t9", []), ("d", 200, "old", [])]
    tables = L.Tables(spark.createDataFrame([(10, "old")], "id long, title string").select(
        *[F.col(f.name).cast(f.dataType) if f.name in ("id", "title") else F.lit(None).cast(f.dataType).alias(f.name) for f in SCH.DISHES_TABLE]),
        spark.createDataFrame([], SCH.DISH_INGREDIENTS_TABLE), spark.createDataFrame([], SCH.INGREDIENTS_TABLE), spark.createDataFrame([], SCH.MEASUREMENTS_TABLE))
    plans = []

    def numbered(df, order, **how):
        if "ingredients" in df.columns:
            with contextlib.redirect_stdout(io.StringIO()) as plan:
                df.explain()
            plans.append(plan.getvalue().splitlines())
        return keys.dense_ids(df, order, **how)

    monkeypatch.setattr(L, "dense_ids", numbered)
    loaded, outcome = L.load_stage(spark.createDataFrame(rows, schema), tables)
    at = max(i for i, line in enumerate(plans[0]) if "WindowGroupLimit" in line)
    below = []
    for line in plans[0][at + 1:]:
        if _indent(line) <= _indent(plans[0][at]):
            break
        below.append(line)
    assert len(plans) == 1 and below and not any("Exchange" in line for line in below)

    got = sorted((str(tuple(r)) for r in outcome.select("dataset", "entryNumber", "title", "dish_id", "status", "error").collect()))
    first = {"t0": (("d", 3), 13), "t1": (("d", 1), 11 + 1), "t2": (("d", 2), 11 + 2), "t9": ((None, None), 11)}
    ids = {t: n for n, t in enumerate(["t9", "t1", "t2", "t0"], 11)}
    want = []
    for d, e, t, _ in rows:
        if t is None:
            want.append((d, e, t, None, "failed", "title missing"))
        elif t == "old":
            want.append((d, e, t, 10, "existing", None))
        elif (d, e) != first[t][0] or None in (d, e):  # a key without all its parts is no known winner
            want.append((d, e, t, ids[t], "existing", None))
    want += [(*key, t, ids[t], "inserted", None) for t, (key, _) in first.items()]
    assert got == sorted(map(str, want))
    assert loaded.dishes.count() == 5 and loaded.ingredients.count() == 3


def test_load_tables_summary_deals_out_the_first_row_of_each_title_only(spark, tmp_path, monkeypatch):
    orders = [(o, f"{o % 4}-P", 1000.0) for o in range(400)] + [(3, "3-P", 1000.0), (None, None, None)]
    lines = [(o, 3 * o + k, k, k) for o in range(400) for k in range(3)] + [(None, 1, 1, 1), (5, None, None, 1), (999, 3, 1, 1)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderpriority string, o_totalprice double").withColumns({
        "o_orderstatus": F.lit("F"), "o_custkey": F.lit(1), "o_orderdate": F.lit("2020-01-01").cast("timestamp")}).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").withColumns({
        "l_quantity": F.lit(1.0), "l_returnflag": F.lit("N"), "l_extendedprice": F.lit(1.0)}).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(p, f"n{p}", "t", "b") for p in range(1200)], "p_partkey long, p_name string, p_type string, p_brand string").write.parquet(
        f"{tmp_path}/part.parquet")
    spark.createDataFrame([(s, f"s{s}", 1) for s in range(3)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    plans = []

    def numbered(df, order, **how):
        if "ingredients" in df.columns:
            with contextlib.redirect_stdout(io.StringIO()) as plan:
                df.explain()
            plans.append(plan.getvalue().splitlines())
        return keys.dense_ids(df, order, **how)

    monkeypatch.setattr(L, "dense_ids", numbered)
    got = E.queries()["load_tables_summary"](spark, str(tmp_path)).collect()
    assert len(plans) == 1
    at = max(i for i, line in enumerate(plans[0]) if "WindowGroupLimit" in line)
    assert not any("Exchange" in line for line in plans[0][at + 1:] if _indent(line) > _indent(plans[0][at]))
    # Orders 0 to 3 are the first of their titles; order 3 is there twice. The order without priority has the title "F".
    assert [tuple(r) for r in got] == [(5, 12, 12, 3)]
