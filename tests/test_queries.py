import pytest
from compare import database, differences

import __spark_entry__ as contract
from gridloom.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    assert set(ORACLES) == set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_is_its_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) is None
