"""Every registered query against its SQL oracle on the smallest given tables."""

import pytest
from compare import difference, duck

import __spark_entry__ as contract
from conftest import TESTDATA
from tagloom.plans.oracles import ORACLES
from tagloom.plans.queries import QUERIES

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry_has_the_event_schema(spark):
    from tagloom.schema import EVENT_COLUMNS

    df = contract.entry(spark)
    assert df.columns == EVENT_COLUMNS
    assert df.limit(1).count() == 1
