import pytest

import __spark_entry__ as contract
from checks.compare import difference, oracle_connection
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    pytest.importorskip("duckdb")
    return oracle_connection(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, oracle, name):
    assert difference(spark, SF_DIR, name, oracle) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
