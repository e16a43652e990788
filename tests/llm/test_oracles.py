"""Every query that SQL can express against its oracle, and that all are registered."""

import re

import pytest

from __spark_entry__ import oracle_sql, queries
from clinlake.llm.queries import ORACLES, QUERIES
from tests.check_oracles import difference, oracle_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_oracle(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), oracle_connection(SF_DIR), ORACLES[name]) is None


def test_all_are_registered():
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES} == set(range(1, 14))
    assert {*QUERIES, "pipeline"} <= queries().keys() and ORACLES.items() <= oracle_sql().items()
