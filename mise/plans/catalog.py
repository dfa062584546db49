"""Registered queries: each binds one operator (or a composition) to the driver's tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs over whole tables; ``ORACLE[name]`` is the
same result written in DuckDB SQL over the raw tables, with the binding of
:mod:`mise.plans.bindings` spelt out in common table expressions.  Column names, and the
rounding of doubles to 6 places, match on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# --------------------------------------------------------------------------- SQL of the bindings
DISHES_CTE = """
dishes AS (
  SELECT o_orderkey AS id,
         'order ' || CAST(o_orderkey AS VARCHAR) AS title,
         CAST(floor(o_totalprice / 5000) AS INTEGER) AS prep_time_minutes,
         CAST(floor(o_totalprice / 2000) AS INTEGER) - CAST(floor(o_totalprice / 5000) AS INTEGER) AS cook_time_minutes,
         CAST(floor(o_totalprice / 2000) AS INTEGER) AS total_time_minutes,
         CAST((o_orderkey % 12) + 1 AS DECIMAL(10,2)) AS servings,
         o_orderstatus AS difficulty,
         o_orderpriority AS cuisine_type,
         lower(substr(o_orderpriority, 3)) AS meal_type,
         'user' || CAST(o_custkey AS VARCHAR) AS post_author,
         CAST(o_custkey % 100 AS INTEGER) AS post_score,
         CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) % 100 AS INTEGER) AS post_comments,
         o_orderdate AS created_at
  FROM orders)"""

# One row per resolved ingredient line of a dish document (inner join = FILTER (i.id IS NOT NULL)).
MENTIONS_CTE = """
mentions AS (
  SELECT l.l_orderkey AS id, p.p_name AS name, l.l_linenumber AS order_index, l.l_partkey, l.l_suppkey,
         l.l_quantity, l.l_extendedprice, l.l_returnflag
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# Importing the query modules fills the registries.
from . import queries_extract, queries_load, queries_posts, queries_relational, queries_search, queries_sources  # noqa: E402,F401,I001
