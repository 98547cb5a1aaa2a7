"""Every query of the incident operators against the SQL that says the same."""

import pytest

from beacongrid.plans import queries as q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(q.SQL))
def test_equals_sql(name, spark, oracle, same):
    assert same(q.QUERIES[name](spark, SF).toPandas(), oracle(q.SQL[name], SF))


@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - set(q.SQL)))
def test_runs(name, spark):
    assert q.QUERIES[name](spark, SF).count() > 0
