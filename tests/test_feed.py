"""Change feed, bounds and incremental aggregates."""

import os
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import changefeed, incremental
from tarnlake.sinks import files as sinks

T1 = datetime(2024, 1, 1)
ROW = "id int, product int, day int, qty decimal(15,2)"


def random_rows(rnd, n, ids):
    return [(i, rnd.randint(0, 3), rnd.randint(0, 3), Decimal(rnd.randint(1, 5))) for i in rnd.sample(range(ids), n)]


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def feed_of(spark, old, new):
    return changefeed.diff(
        spark.createDataFrame(old, ROW), spark.createDataFrame(new, ROW), ["id"], 1, F.lit(str(T1))
    )


@pytest.mark.parametrize("seed", range(2))
def test_replaying_the_feed_gives_the_new_snapshot(spark, seed):
    rnd = random.Random(seed)
    old, new = random_rows(rnd, 20, 40), random_rows(rnd, 25, 40)
    feed = feed_of(spark, old, new)
    replayed = changefeed.replay(spark.createDataFrame(old, ROW), feed, ["id"])
    assert sorted_rows(replayed) == sorted(new, key=str)
    assert feed_of(spark, old, old).isEmpty()


def test_last_of_several_changes_in_one_commit(spark):
    rows = [(1, "delete", 1), (1, "insert", 1), (2, "update_preimage", 1), (2, "update_postimage", 1), (2, "delete", 2)]
    feed = spark.createDataFrame(rows, "id int, _change_type string, _commit_version long").withColumn(
        "_commit_timestamp", F.lit(str(T1)).cast("timestamp_ntz"))
    got = {r["id"]: r["_change_type"] for r in changefeed.net_changes(feed, ["id"]).collect()}
    assert got == {1: "insert", 2: "delete"}


def recomputed(rows):
    out = {}
    for _, p, d, q in rows:
        out[(p, d)] = out.get((p, d), 0) + q
    return sorted((p, d, q) for (p, d), q in out.items())


@pytest.mark.parametrize("seed", range(2))
def test_incremental_aggregates_equal_a_full_recompute(spark, seed):
    rnd = random.Random(10 + seed)
    old, new = random_rows(rnd, 15, 30), random_rows(rnd, 15, 30)
    before, after = spark.createDataFrame(old, ROW), spark.createDataFrame(new, ROW)
    current = before.groupBy("product", "day").agg(
        F.sum("qty").cast("decimal(25,2)").alias("sold_qty"), F.count("*").alias("n_rows"),
        F.lit(str(T1 - timedelta(days=1))).cast("timestamp_ntz").alias("record_commit_timestamp"),
    )
    feed, keys = feed_of(spark, old, new), ["product", "day"]
    again = incremental.recompute_affected(current.drop("n_rows"), after, feed, keys, "qty")
    deltas = incremental.apply_deltas(current, feed, keys, "qty")
    want = recomputed(new)
    assert sorted(map(tuple, again.select("product", "day", "sold_qty").collect())) == want
    assert sorted(map(tuple, deltas.select("product", "day", "sold_qty").collect())) == want
    assert sorted_rows(again) == sorted_rows(deltas.drop("n_rows"))


def bounds(spark, first, last, processed, end):
    feed = spark.createDataFrame([(first, last, 0, 3)],
                                 "first_commit_ts timestamp_ntz, last_commit_ts timestamp_ntz, first_version long, "
                                 "last_version long")
    done = spark.createDataFrame([(processed,)], "last_processed_ts timestamp_ntz")
    return tuple(incremental.bounds(feed, done, F.lit(str(end))).first())


def test_incremental_bounds(spark):
    d = [T1 + timedelta(days=i) for i in range(6)]
    assert bounds(spark, d[0], d[4], None, d[5]) == (None, d[0], d[4])
    assert bounds(spark, d[0], d[4], d[2], d[3]) == (None, d[2], d[3])
    assert bounds(spark, d[0], d[4], d[4], d[5]) == (None, d[4], None)
    assert bounds(spark, None, None, None, d[5]) == (0, None, None)


def test_lookback_reads_late_rows_again(spark):
    days = [(i, T1 + timedelta(days=i), round((T1 + timedelta(days=i)).timestamp() * 1000)) for i in range(10)]
    df = spark.createDataFrame(days, "i int, t timestamp_ntz, ms long")
    for column in ("t", "ms"):
        got = incremental.lookback_window(df, column, T1 + timedelta(days=5), T1 + timedelta(days=6))
        assert sorted(r["i"] for r in got.collect()) == [2, 3, 4, 5]


def test_since_last(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "v long")
    assert incremental.since_last(df, "v", df.filter("v < 3"), "v").count() == 2
    assert incremental.since_last(df, "v", df.limit(0), "v").count() == 3


def test_only_touched_partitions_are_written_again(spark, tmp_path):
    path = str(tmp_path / "daily")
    old = [(i, i % 4, i % 5, Decimal(i)) for i in range(60)]
    # day 0: a change; day 1: a row more; day 2: all rows gone; day 3 untouched; day 4: a row changed to what it was
    new = [(i, p, d, q + 1 if (d, p) == (0, 0) else q) for i, p, d, q in old if d != 2] + [(99, 1, 1, Decimal(7)), (98, 3, 7, Decimal(2))]

    def sums(rows):
        out = {}
        for _, p, d, q in rows:
            out[p, d] = out.get((p, d), 0) + q
        return out

    stored = [(p, d, q, T1) for (p, d), q in sums(old).items()]
    sinks.write_partitions(spark.createDataFrame(stored, "product int, day int, sold_qty decimal(25,2), record_commit_timestamp timestamp_ntz"), path, ["day"])
    before = {d: sorted(os.listdir(f"{path}/day={d}")) for d in range(5)}
    later = F.lit("2024-02-01").cast("timestamp_ntz")
    feed = feed_of(spark, old, new).withColumn("_commit_timestamp", later)
    base = spark.createDataFrame(new, ROW)
    touched = incremental.overwrite_affected(spark, path, base, feed, ["product"], "day", "qty")
    assert touched == [0, 1, 2, 7]
    after = {(r["product"], r["day"]): r["sold_qty"] for r in spark.read.parquet(path).collect()}
    assert after == sums(new)
    assert not os.path.exists(f"{path}/day=2")
    assert all(sorted(os.listdir(f"{path}/day={d}")) == before[d] for d in (3, 4)) and sorted(os.listdir(f"{path}/day=0")) != before[0]
    assert incremental.overwrite_affected(spark, path, base, feed.limit(0), ["product"], "day", "qty") == []
