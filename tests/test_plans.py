"""What the plans look like: pushdown, pruning, map-side reduction, joins without broadcasts."""

import re

import __spark_entry__ as entry

QUERIES = entry.queries()


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(spark, sf_dir, "tpch_q6")
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_quantity,24.0)" in text
    assert "GreaterThanOrEqual(l_discount" in text
    assert re.search(r"ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,l_shipdate:\w+>", text)
    assert re.search(r"ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>", plan(spark, sf_dir, "tpch_q3"))


def test_exists_becomes_a_semi_join(spark, sf_dir):
    assert "LeftSemi" in plan(spark, sf_dir, "tpch_q4")


def test_latest_row_is_cut_down_before_the_shuffle(spark, sf_dir):
    text = plan(spark, sf_dir, "cdc_latest")
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_without_broadcasts_joins_still_avoid_pairs(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("tpch_q5", "merge_upsert", "scd2_apply_batch", "fact_line_item"):
            text = plan(spark, sf_dir, name)
            assert "SortMergeJoin" in text
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
