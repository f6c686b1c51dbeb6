"""Registered queries against their SQL twins at the smallest scale."""

import pytest

from compare import differences, duck
from marketloom.queries import all_queries

SF = "/root/testdata/sf0.001"
@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    q = all_queries()[name]
    assert q.oracle, "every query has a twin"
    assert differences(q(spark, SF), con, q.oracle) is None
