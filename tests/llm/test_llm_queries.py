"""Registered queries of the package against their SQL, over whole tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, duck
from tarnlake.llm.queries import ORACLE, QUERIES

NATIVE = ["op5_mix_sources", "op9_line_runs", "op10_tool_calls"]


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, sf_dir, name):
    df, got, want = compare(spark, con, sf_dir, entry.queries()[name], ORACLE[name])
    assert got == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    unwanted = ["CartesianProduct", "BroadcastNestedLoopJoin", *(["Python", "Arrow", "Pandas"] if name in NATIVE else [])]
    assert not [node for node in unwanted if node in plan]


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
