"""Every query of the catalogue against its SQL on the smallest tables; the text operators have tests of their own."""

import pytest

import __spark_entry__ as entry
from catalog import load
from tools.check import compare, connect

SLOW = {"walk_forward_predict"}  # hundreds of forests; its parts are tested one by one


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(set(load()[0]) - SLOW))
def test_query(spark, folder, duck, name):
    df = entry.queries()[name](spark, folder)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is not None:
        assert compare(rows, df.schema, duck.sql(sql).to_arrow_table()) == ""


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
