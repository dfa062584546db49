"""Plan checks for scale: no cross joins anywhere, map-side limits for top-k per group, pruned scans."""

import contextlib
import io

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cross_joins(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans a {op}"


@pytest.mark.parametrize("name", ["top_ingredients_per_cuisine", "cuisine_top_hits", "cuisine_difficulty",
                                  "top_ingredients_with_titles", "dedupe_documents"])
def test_top_k_per_group_is_limited_map_side(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(E.queries()["top_ingredients_per_cuisine"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "l_extendedprice" not in plan
