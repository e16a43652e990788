"""Every registered query against its oracle SQL on the smallest data set."""

import pytest

from __spark_entry__ import entry
from tests.check_oracles import difference, oracle_connection
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_oracle(spark, oracle, name):
    assert difference(QUERIES[name](spark, SF_DIR), oracle, ORACLES[name]) is None


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0
