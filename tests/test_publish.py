"""Publishing, numbers of new versions, statistics, job parameters, inline rows."""

import uuid

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import maintain, scd2, surrogate
from tarnlake.plans import erp, publish, storage
from tarnlake.plans.inputs import Tables, ts
from tarnlake.session import job_parameter, job_parameters
from tarnlake.sinks import files as sinks
from tarnlake.sources import files

DIM = "k bigint, v string, sk bigint"


def held(spark):
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, None, 3)], DIM)
    return scd2.as_dimension(rows, ts("2024-01-01 00:00:00"))


def test_stage_numbers_new_versions_after_the_old_and_publish_closes_and_inserts(spark):
    dim = held(spark)
    source = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (9, "n"), (None, "x")], "k bigint, v string")
    stage = publish.stage(dim, source, ["k"], ["v"], "sk")
    out = scd2.publish(stage, dim, "sk")
    got = sorted((r["sk"], r["k"], r["v"], r[scd2.ACTIVE]) for r in out.collect())
    assert got == [(1, 1, "a", True), (2, 2, "b", False), (3, 3, None, True), (4, 2, "B", True), (5, 9, "n", True)]


def test_publishing_the_same_stage_twice_changes_nothing(spark):
    dim = held(spark)
    source = spark.createDataFrame([(2, "B"), (4, "d")], "k bigint, v string")
    stage = publish.stage(dim, source, ["k"], ["v"], "sk")
    once = scd2.publish(stage, dim, "sk")
    twice = scd2.publish(stage, once, "sk")
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    # nor does applying the same source to the published rows
    again = publish.stage(once, source, ["k"], ["v"], "sk")
    assert sorted(map(str, once.collect())) == sorted(map(str, again.select(once.columns).collect()))


def test_rows_with_a_number_keep_it(spark):
    rows = spark.createDataFrame([("a", 7), ("b", None), ("c", None)], "k string, sk bigint")
    got = {r["k"]: r["sk"] for r in surrogate.assign_missing(rows, "sk", ["k"], rows).collect()}
    assert got == {"a": 7, "b": 8, "c": 9}
    empty = rows.filter("sk is not null")
    assert [tuple(r) for r in surrogate.assign_missing(empty, "sk", ["k"], rows).collect()] == [("a", 7)]


def test_published_fact_has_one_active_version_per_line(spark, sf_dir):
    t = Tables(spark, sf_dir)
    fact = publish._line_item(t)
    active = scd2.current(fact)
    n = t.lineitem.count()
    assert active.count() == n == active.select("l_orderkey", "l_linenumber").distinct().count()
    # every active line refers to active versions only
    for name, sk in (("customer", "sk_custkey"), ("part", "sk_partkey"), ("supplier", "sk_suppkey"), ("order", "sk_orderkey")):
        assert active.join(scd2.current(publish._published(t)[name]), sk, "left_anti").isEmpty(), name


def test_raw_state_is_that_of_the_whole_log(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rows = erp.typed_rows(erp.order_messages(t.orders), erp.ORDER_DDL, erp.ORDER_FIELDS, erp._ORDER_TIMES)
    state = erp.QUERIES["erp_raw_sale_order"](t)
    assert state.count() == rows.select("id").distinct().count()
    deleted = rows.filter(F.col("op") == "d")
    assert deleted.count() > 0
    assert state.filter("delete_ts is not null").select("id", "state", "date_order").exceptAll(deleted.select("id", "state", "date_order")).isEmpty()
    assert state.filter("delete_ts is not null").count() == deleted.count()


def test_statistics_come_from_the_catalog(spark, tmp_path):
    name = f"stats_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    try:
        sinks.save_as(spark.createDataFrame([(3, "x"), (None, "y"), (-4, None)], "`n m` bigint, s string"), f"{name}.t")
        before = maintain.statistics(spark, f"{name}.t", ["n m"]).collect()
        assert before[0]["min_value"] is None and before[0]["n_nulls"] is None
        maintain.analyze(spark, f"{name}.t", ["`n m`", "s"])
        got = [tuple(r) for r in maintain.statistics(spark, f"{name}.t", ["n m", "s"]).collect()]
        assert got == [("n m", 3, 1, "-4", "3"), ("s", 3, 1, None, None)]
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_job_parameters_hold_for_the_block(spark):
    with job_parameters(spark, table="a"):
        with job_parameters(spark, table="b", other="c"):
            assert (job_parameter(spark, "table"), job_parameter(spark, "other")) == ("b", "c")
        assert (job_parameter(spark, "table"), job_parameter(spark, "other", "none")) == ("a", "none")
    assert job_parameter(spark, "table") is None
    with pytest.raises(ValueError):
        with job_parameters(spark, table="a"):
            raise ValueError
    assert job_parameter(spark, "table") is None


def test_catalog_queries_leave_no_database(spark, sf_dir):
    before = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    t = Tables(spark, sf_dir)
    listed = storage.QUERIES["src_catalog_listing"](t)
    assert listed.count() == 3                               # written before its tables went
    assert {r[0] for r in spark.sql("SHOW DATABASES").collect()} == before


def test_inline_rows_take_a_schema(spark):
    rows = files.inline(spark, [(1, None), (2, "b")], "a int, b string")
    assert rows.schema.simpleString() == "struct<a:int,b:string>" and rows.count() == 2
    assert files.inline(spark, [], "a int").count() == 0
