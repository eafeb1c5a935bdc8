"""Every query against its SQL on the smallest tables, and the shape of the registry."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns[:4] == ["year", "month", "type", "ocorrencias"] and got.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", ["f17_filter_cascade", "j3_centroid_lookup", "j6_near_duplicate_anti_join", "j10_cross_validation", "x7_place_in_title"])
def test_no_pairwise_joins(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
