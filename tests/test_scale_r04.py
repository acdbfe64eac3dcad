"""What a run leaves on disks and in the driver: files that go when they are not needed any more, sides that are not broadcast."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import asof, incremental, scd2
from tarnlake.plans import publish
from tarnlake.plans.inputs import Tables
from tarnlake.session import shared_root, staged, staging

LIMIT = "spark.sql.autoBroadcastJoinThreshold"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.collect()))


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",").split(",")
    return {f for f in files if "shuffle_" in f}


@pytest.fixture
def limit(spark):
    before = spark.conf.get(LIMIT)
    yield lambda size: spark.conf.set(LIMIT, size)
    spark.conf.set(LIMIT, before)


# --- publish_line_item_fact ---------------------------------------------------------------

def test_shuffle_files_go_when_the_rows_are_staged(spark):
    """When they are written, not when the driver collects its garbage."""
    before = _shuffle_files(spark)
    staged(spark.range(1000).repartition(3, "id"), "freed")
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_staging_blocks_nest(spark):
    with staging(spark):
        with staging(spark):
            pass
        staged(spark.range(1), "of-the-outer-block")
    assert not [name for name in os.listdir(shared_root(spark).removeprefix("file:")) if name.startswith("of-the-outer-block")]


def test_what_a_layer_staged_goes(spark, sf_dir):
    t = Tables(spark, sf_dir)
    layer = t.layer("layer_of_a_stage", lambda: staged(spark.range(5), "under-a-layer"))
    assert layer.count() == 5
    assert not [name for name in os.listdir(shared_root(spark).removeprefix("file:")) if name.startswith("under-a-layer")]


def test_the_warehouse_fact_is_not_stored_twice(spark, sf_dir, monkeypatch):
    built = []
    layer = Tables.layer
    monkeypatch.setattr(Tables, "layer", lambda t, name, build: built.append(name) or layer(t, name, build))
    publish._line_item(Tables(spark, sf_dir))
    assert {"fact_line_item", "stage_line_item"} <= set(built) and "warehouse_line_item" not in built


def _snapshot(spark, key="k int"):
    day = "timestamp_ntz '2024-01-01 00:00:00'"
    held = scd2.as_dimension(spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (2, 1, None), (3, 1, "c"), (None, 1, "n"), (4, None, "m")], "k int, j int, v string"), F.expr(day))
    closed = held.limit(1).withColumns({"v": F.lit("old"), scd2.ACTIVE: F.lit(False), scd2.END: F.expr(day)})
    source = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "B"), (2, 1, None), (3, 2, "new"), (5, 5, None), (None, 1, "x"), (4, None, "y")], f"{key}, j int, v string")
    return held.unionByName(closed), source


@pytest.mark.parametrize("key", ["k int", "k long"])
def test_a_snapshot_applied_in_slices_is_the_snapshot(spark, key):
    dim, source = _snapshot(spark, key)
    now = F.lit("2024-02-01 00:00:00")
    whole = scd2.apply_snapshot(dim, source, ["k", "j"], ["v"], now)
    for at_once in (1, 2, 4, 100):
        sliced = scd2.apply_snapshot(dim, source, ["k", "j"], ["v"], now, at_once)
        assert sliced.schema == whole.schema and _rows(sliced) == _rows(whole)
    with pytest.raises(ValueError):
        scd2.apply_snapshot(dim, source.unionByName(source), ["k", "j"], ["v"], now, 2)


def test_a_large_snapshot_is_written_slice_by_slice(spark):
    dim, source = _snapshot(spark)
    assert "FullOuter" in _plan(scd2.apply_snapshot(dim, source, ["k", "j"], ["v"], F.lit("2024-02-01 00:00:00"), 5))
    assert "FullOuter" not in _plan(scd2.apply_snapshot(dim, source, ["k", "j"], ["v"], F.lit("2024-02-01 00:00:00"), 4))


def test_the_published_fact_is_the_same_in_slices(spark, sf_dir, monkeypatch):
    t = Tables(spark, sf_dir)
    whole = publish._line_item(t)
    monkeypatch.setattr(publish, "LINES_AT_ONCE", 2000)
    sliced = publish._line_item(t)
    assert sliced.exceptAll(whole).isEmpty() and whole.exceptAll(sliced).isEmpty()


# --- erp_incr_daily_sales -----------------------------------------------------------------

def test_versions_of_many_keys_are_not_broadcast_for_their_small_file(spark, limit):
    versions = staged(spark.range(20_000).selectExpr(
        "id k", "timestamp_ntz '2024-01-01 00:00:00' s", "timestamp_ntz '9999-12-31 00:00:00' e", "'x' v", "'y' w"), "versions")
    events = staged(spark.range(100_000).selectExpr("if(id % 7 = 0, null, id % 30000) k", "timestamp_ntz '2024-03-01 00:00:00' t"), "events")
    limit("120000")

    def join(of):
        return asof.interval_join(events, of, ["k"], "t", "s", "e", ["v"])

    assert versions._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 120_000      # 20,000 rows, 5 columns
    assert "BroadcastHashJoin" not in _plan(join(versions)) and "SortMergeJoin" in _plan(join(versions))
    assert "BroadcastHashJoin" in _plan(join(staged(versions.filter("k < 1000"), "few-versions")))
    got = join(versions).groupBy("v").count().collect()
    met = sum(1 for i in range(100_000) if i % 7 and i % 30_000 < 20_000)
    assert {r["v"]: r["count"] for r in got} == {"x": met, None: 100_000 - met}


def test_sums_of_many_touched_keys_meet_the_aggregate_once(spark, limit):
    at = "timestamp_ntz '2024-01-0{} 00:00:00'"
    current = spark.sql(f"""select k, q.sold_qty, {at.format(1)} record_commit_timestamp
        from values (1, 5), (2, 7), (3, 9), (null, 4) as q(k, sold_qty)""").selectExpr("k", "cast(sold_qty as long) sold_qty", "record_commit_timestamp")
    base = spark.sql("select * from values (1, 5), (2, 3), (2, 5), (4, 1), (null, 6) as b(k, qty)")
    feed = staged(spark.sql(f"select k, {at.format(2)} _commit_timestamp from values (1), (2), (3), (4), (6), (null) as f(k)"), "feed")

    def run(stored):
        return incremental.recompute_affected(current, base, feed, ["k"], "qty", stored=stored)

    limit("-1")
    apart, together = run(False), run(True)
    assert "FullOuter" in _plan(together) and "FullOuter" not in _plan(apart)
    assert _rows(together) == _rows(apart) and together.schema == apart.schema
    limit("10MB")
    assert "FullOuter" not in _plan(run(True))
