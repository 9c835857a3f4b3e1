"""Every registered query against its SQL on the smallest sample tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import connect, difference
from starloom.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = queries()[name](spark, FOLDER).toPandas()
    assert difference(got, duck.execute(oracle_sql()[name]).df()) == ""


def test_registry():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) - set(oracle_sql()) == {"mllib_als"}


def test_library_als_learns(spark):
    row = queries()["mllib_als"](spark, FOLDER).first()
    assert row["n"] == 5382 and row["mse"] < 2.0


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["user", "item", "predict", "rank"]
    assert frame.count() == 150 * 12
