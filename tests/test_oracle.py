"""Every registered query against its SQL. TEST_SF_DIR picks the tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from outreach.workload.oracle import ORACLES as OWN_ORACLES
from outreach.workload.queries import REGISTRY

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(OWN_ORACLES) <= set(ORACLES)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None
