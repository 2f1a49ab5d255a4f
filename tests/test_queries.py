"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from tests.oracle import canonical, connect, kinds

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    with connect(SF_DIR) as connection:
        yield connection


LIBRARY = sorted(set(contract.queries()) - set(contract.LLM_QUERIES))


def test_every_query_has_sql():
    assert set(contract.oracle_sql()) - set(contract.LLM_SQL) == set(LIBRARY)


@pytest.mark.parametrize("name", LIBRARY)
def test_query_equals_sql(spark, duck, name):
    found = contract.queries()[name](spark, SF_DIR).toPandas()
    expected = duck.execute(contract.oracle_sql()[name]).df()
    assert kinds(found) == kinds(expected)
    assert canonical(found) == canonical(expected)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["window_start", "window_end", "user_id", "cnt"]
    assert not result.isEmpty()
