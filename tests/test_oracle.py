"""Every registered query against its DuckDB SQL on the smallest tables (the driver's check, locally)."""

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query(spark, con, name):
    fn = E.queries()[name]
    if name not in SQL:
        fn(spark, SF).count()
        return
    ok, _ = compare(spark, name, fn, SQL[name], SF, con)
    assert ok


def test_entry(spark):
    assert E.entry(spark).count() == 50
