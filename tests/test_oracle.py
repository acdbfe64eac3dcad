"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, duck

# pair joins, and expressions that leave the JVM
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]
# the queries of the optional part have tests of their own
OWN = {name for module in entry._plans() for name in module.QUERIES}
QUERIES = {name: query for name, query in entry.queries().items() if name in OWN}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, sf_dir, name):
    df, got, want = compare(spark, con, sf_dir, QUERIES[name], SQL[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_queries_without_sql_run(spark, sf_dir):
    for name in sorted(set(QUERIES) - set(SQL)):
        assert QUERIES[name](spark, sf_dir).count() > 0, name


def test_entry(spark):
    assert entry.entry(spark).columns == ["l_orderkey", "revenue", "o_orderdate"]
