"""History: the eight-event scenario, idempotence, batching, and large keys cut into slices."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import asof, runs, scd2, surrogate
from tarnlake.operators.cdc import latest_changes
from tarnlake.operators.runs import carry_forward, numbered, split, unsplit

EVENTS = [
    (124, "Raul", "Oaxaca", "INSERT", 1), (123, "Isabel", "Monterrey", "INSERT", 1),
    (125, "Mercedes", "Tijuana", "INSERT", 2), (126, "Lily", "Cancun", "INSERT", 2),
    (123, None, None, "DELETE", 6), (125, "Mercedes", "Guadalajara", "UPDATE", 6),
    (125, "Mercedes", "Mexicali", "UPDATE", 5), (123, "Isabel", "Chihuahua", "UPDATE", 5),
]
OPEN = datetime(9999, 12, 31)


def user_history(spark, events, **how):
    log = spark.createDataFrame(events, "userId int, name string, city string, operation string, seq int")
    log = log.withColumn("at", F.add_months(F.lit(date(2025, 1, 1)), F.col("seq")).cast("timestamp_ntz"))
    out = scd2.history(log, ["userId"], "seq", ["name", "city"], "at", F.col("operation") == "DELETE", **how)
    return sorted(
        (r["userId"], r["city"], r["seq"], r[scd2.ACTIVE], r[scd2.START].month, r[scd2.END]) for r in out.collect()
    )


def day(month):
    return datetime(2025, month, 1)


EXPECTED = sorted([
    (123, "Monterrey", 1, False, 2, day(6)), (123, "Chihuahua", 5, False, 6, day(7)),
    (124, "Oaxaca", 1, True, 2, OPEN), (125, "Tijuana", 2, False, 3, day(6)),
    (125, "Mexicali", 5, False, 6, day(7)), (125, "Guadalajara", 6, True, 7, OPEN), (126, "Cancun", 2, True, 3, OPEN),
])


def test_eight_events(spark):
    assert user_history(spark, EVENTS) == EXPECTED
    assert user_history(spark, EVENTS, rows_per_task=1) == EXPECTED


def test_eight_events_and_a_late_delete(spark):
    got = user_history(spark, [*EVENTS, (125, None, None, "DELETE", 7)])
    assert (125, "Guadalajara", 6, False, 7, day(8)) in got
    assert not any(r[0] == 125 and r[3] for r in got)


LOG = "id int, lsn long, op string, v string, at timestamp_ntz"


def random_log(rnd, n=400, hot=0.4):
    t = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        t += timedelta(seconds=rnd.randint(1, 5000))
        rows.append((0 if rnd.random() < hot else rnd.randint(1, 12), i * rnd.choice((1, 1, 1)) + 5,
                     rnd.choice("cuuud"), rnd.choice(["a", "b", None]), t))
    return rows


def brute_history(rows):
    out = []
    for key in {r[0] for r in rows}:
        last = None
        for _, lsn, op, v, at in sorted(r for r in rows if r[0] == key):
            if op == "d":
                if last:
                    last[4], last[3] = at, False
                last = None
            elif last is None or last[1] != v:
                if last:
                    last[4], last[3] = at, False
                last = [key, v, at, True, OPEN]
                out.append(last)
    return sorted((tuple(r) for r in out), key=str)


def spark_history(df, rows_per_task):
    out = scd2.history(df, ["id"], "lsn", ["v"], "at", F.col("op") == "d", rows_per_task)
    return sorted(((r["id"], r["v"], r[scd2.START], r[scd2.ACTIVE], r[scd2.END]) for r in out.collect()), key=str)


@pytest.mark.parametrize("seed, rows_per_task", [(0, 1 << 23), (0, 40), (1, 7), (2, 1)])
def test_history_equals_brute_force_however_keys_are_cut(spark, seed, rows_per_task):
    rows = random_log(random.Random(seed))
    assert spark_history(spark.createDataFrame(rows, LOG), rows_per_task) == brute_history(rows)


def test_a_hot_key_is_spread_over_many_slices(spark):
    log = spark.range(30_000).select(
        F.when(F.col("id") < 20_000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("lsn")
    )
    sizes = split(log, ["k"], F.col("lsn"), 1000).groupBy("k", "__slice").count()
    assert sizes.agg(F.max("count")).first()[0] <= 1000
    assert sizes.filter("k = 0").count() >= 20
    assert sizes.filter("k > 0 and __slice > 0").isEmpty()


@pytest.mark.parametrize("descending", [True, False])
def test_numbering_across_slices(spark, descending):
    log = spark.range(500).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"), "id")
    cut = unsplit(numbered(split(log, ["k"], F.col("id"), 9), ["k"], "id", "n", descending))
    plain = numbered(log, ["k"], "id", "n", descending)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("rows_per_task", [1 << 23, 11])
def test_point_in_time_equals_nested_loops(spark, rows_per_task):
    rnd = random.Random(5)
    rows = random_log(rnd, 300)
    versions = [(k, v, a, e) for k, v, a, _, e in brute_history(rows)]
    t0 = datetime(2024, 1, 1)
    events = [(i, rnd.randint(0, 14), t0 + timedelta(seconds=rnd.randint(-50, 900_000))) for i in range(400)]
    events += [(1000 + i, k, a) for i, (k, _, a, _) in enumerate(versions)] + [(9999, 3, None)]
    want = sorted(
        (i, k, t, next((v for vk, v, a, e in versions if t and vk == k and a <= t < e), None)) if t else (i, k, t, None)
        for i, k, t in events
    )
    ev = spark.createDataFrame(events, "i int, k int, t timestamp_ntz")
    ver = spark.createDataFrame(versions, "k int, v string, s timestamp_ntz, e timestamp_ntz")
    line = asof.point_in_time_join(ev, ver, ["k"], "t", "s", "e", ["v"], rows_per_task)
    both = asof.interval_join(ev, ver, ["k"], "t", "s", "e", ["v"], few=20)
    assert sorted(map(tuple, line.collect())) == want
    assert sorted(map(tuple, both.collect())) == want


DIM = "id int, v string, record_active_flag boolean, record_start_date timestamp_ntz, record_end_date timestamp_ntz"


def test_applying_batches_is_idempotent_and_leaves_no_gaps(spark):
    rows = [r for r in random_log(random.Random(3), 120) if r[2] != "d"]
    dim = spark.createDataFrame([], DIM)
    for n in range(0, len(rows), 40):
        # one change per key and batch, as the change feed hands them over
        batch = spark.createDataFrame(rows[n:n + 40], LOG)
        latest = latest_changes(batch, ["id"], ["lsn"])
        once = scd2.apply_changes(dim, latest, ["id"], ["v"], "at")
        twice = scd2.apply_changes(once, latest, ["id"], ["v"], "at")
        assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
        dim = spark.createDataFrame([tuple(r) for r in once.collect()], DIM)
    assert dim.filter(scd2.ACTIVE).groupBy("id").count().filter("count > 1").isEmpty()
    pieces = sorted((r["id"], r[scd2.START], r[scd2.END]) for r in dim.collect())
    for a, b in zip(pieces, pieces[1:]):
        assert a[0] != b[0] or a[2] == b[1]


def test_returning_key_is_inserted_and_new_values_are_kept(spark):
    t = datetime(2024, 1, 1)
    dim = spark.createDataFrame([(1, "a", False, t, t + timedelta(days=1)), (2, "x", True, t, OPEN)], DIM)
    later = t + timedelta(days=5)
    changes = spark.createDataFrame([(1, "a", later), (2, "y", later)], "id int, v string, at timestamp_ntz")
    out = sorted(tuple(r) for r in scd2.apply_changes(dim, changes, ["id"], ["v"], "at").collect())
    assert out == [(1, "a", False, t, t + timedelta(days=1)), (1, "a", True, later, OPEN),
                   (2, "x", False, t, later), (2, "y", True, later, OPEN)]


def test_snapshot_twice_is_once_and_nulls_compare(spark):
    t, later = datetime(2024, 1, 1), datetime(2024, 2, 1)
    dim = spark.createDataFrame([(1, None, True, t, OPEN), (2, "b", True, t, OPEN), (3, "c", True, t, OPEN)], DIM)
    source = spark.createDataFrame([(1, None), (2, None), (4, "d")], "id int, v string")
    once = scd2.apply_snapshot(dim, source, ["id"], ["v"], F.lit(str(later)))
    twice = scd2.apply_snapshot(once, source, ["id"], ["v"], F.lit(str(later + timedelta(days=1))))
    want = sorted([(1, None, True, t, OPEN), (2, "b", False, t, later), (2, None, True, later, OPEN),
                   (3, "c", True, t, OPEN), (4, "d", True, later, OPEN)], key=str)
    assert sorted(map(tuple, once.collect()), key=str) == want
    assert sorted(map(tuple, twice.collect()), key=str) == want


def test_publish_closes_what_the_stage_closed(spark):
    t, later = datetime(2024, 1, 1), datetime(2024, 2, 1)
    ddl = f"sk long, {DIM}"
    warehouse = spark.createDataFrame([(1, 7, "a", True, t, OPEN)], ddl)
    stage = spark.createDataFrame([(1, 7, "a", False, t, later), (2, 7, "b", True, later, OPEN)], ddl)
    out = scd2.publish(stage, warehouse, "sk")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, stage.collect()))


def test_surrogate_keys_are_dense_and_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("hot"), (-F.col("id")).alias("x"))
    first = surrogate.assign(df, "sk", ["hot", "x"])
    rows = sorted((r["hot"], r["x"], r["sk"]) for r in first.collect())
    assert [r[2] for r in rows] == list(range(1, 1001))
    fresh = spark.range(5).select(F.lit(9).alias("hot"), F.col("id").alias("x"))
    more = surrogate.assign(fresh, "sk", ["hot", "x"], first)
    assert sorted(r["sk"] for r in more.collect()) == list(range(1001, 1006))


def test_carry_forward_reaches_over_empty_slices(spark):
    rows = [(1, i, "m" if i == 3 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, i long, m string")
    out = carry_forward(split(df, ["k"], F.col("i"), 4), ["k"], "i", F.col("m").isNotNull(), ["m"], "c")
    assert {r["i"]: r["c"] and r["c"]["m"] for r in out.collect()} == {i: "m" if i >= 3 else None for i in range(100)}


VER = "k int, v string, s timestamp_ntz, e timestamp_ntz"


@pytest.mark.parametrize("few", [0, 64])
@pytest.mark.parametrize("rows_per_task", [1, 1 << 23])
def test_versions_of_no_length_and_null_keys_in_point_in_time_joins(spark, few, rows_per_task):
    """A version that ends when it starts holds at no time, wherever it is stored; events without a key meet nothing."""
    d = [datetime(2024, 1, n) for n in range(1, 10)]
    versions = [(1, "a", d[0], d[1]), (1, "c", d[1], OPEN), (1, "b", d[1], d[1]), (2, "x", d[2], d[3]), (2, "y", d[3], d[3]),
                (2, "z", d[5], OPEN), (None, "n", d[0], OPEN), (3, "w", None, OPEN)]
    events = [(i, k, t) for i, (k, t) in enumerate([(1, d[0]), (1, d[1]), (1, d[2]), (2, d[2]), (2, d[3]), (2, d[5]), (None, d[3]),
                                                    (3, d[3]), (1, None), (4, d[4])] * 3)]
    want = ["a", "c", "c", "x", None, "z", None, None, None, None] * 3
    for order in (versions, versions[::-1]):
        ev, ver = spark.createDataFrame(events, "i int, k int, t timestamp_ntz"), spark.createDataFrame(order, VER)
        for out in (asof.point_in_time_join(ev, ver, ["k"], "t", "s", "e", ["v"], rows_per_task),
                    asof.interval_join(ev, ver, ["k"], "t", "s", "e", ["v"], few)):
            assert [r["v"] for r in sorted(out.collect(), key=lambda r: r["i"])] == want


def test_bursts_and_null_keys_are_cut_evenly(spark):
    crowded = spark.range(30_000).select(
        F.when(F.col("id") < 29_000, F.col("id")).otherwise(F.col("id") * 1_000_000).alias("at"), F.lit(1).alias("k"))
    nameless = spark.range(30_000).select(F.col("id").alias("at"), F.lit(None).cast("int").alias("k"))
    sizes = split(crowded.unionByName(nameless), ["k"], F.col("at"), 1000).groupBy("k", "__slice").count()
    assert sizes.agg(F.max("count")).first()[0] <= 1000
    assert sizes.agg(F.sum("count")).first()[0] == 60_000


def test_tables_without_large_keys_come_back_as_they_are(spark):
    log = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    assert split(log, ["k"], F.col("id"), 100) is log


def test_history_and_point_in_time_read_their_input_once_without_large_keys(spark, tmp_path):
    spark.createDataFrame(random_log(random.Random(1)), LOG).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    plan = scd2.history(log, ["id"], "lsn", ["v"], "at", F.col("op") == "d")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_a_stale_change_does_not_revive_a_closed_key(spark):
    t = datetime(2024, 1, 1)
    closed = [(1, "a", False, t, t + timedelta(days=4))]
    dim = spark.createDataFrame(closed, DIM)
    stale = spark.createDataFrame([(1, "b", t + timedelta(days=2))], "id int, v string, at timestamp_ntz")
    assert [tuple(r) for r in scd2.apply_changes(dim, stale, ["id"], ["v"], "at").collect()] == closed
    on_time = spark.createDataFrame([(1, "b", t + timedelta(days=4))], "id int, v string, at timestamp_ntz")
    assert scd2.apply_changes(dim, on_time, ["id"], ["v"], "at").filter(scd2.ACTIVE).count() == 1


def test_several_rows_for_one_key_are_refused_and_none_change_nothing(spark):
    t = datetime(2024, 1, 1)
    dim = spark.createDataFrame([(1, "a", True, t, OPEN)], DIM)
    twice = spark.createDataFrame([(1, "b", t + timedelta(days=2)), (1, "c", t + timedelta(days=3))], "id int, v string, at timestamp_ntz")
    with pytest.raises(ValueError, match="several rows"):
        scd2.apply_changes(dim, twice, ["id"], ["v"], "at")
    with pytest.raises(ValueError, match="several rows"):
        scd2.apply_snapshot(dim, twice.drop("at"), ["id"], ["v"], F.lit(str(t)))
    assert scd2.apply_changes(dim, twice.limit(0), ["id"], ["v"], "at") is dim


def test_surrogate_keys_without_an_order_are_dense_and_move_nothing(spark):
    df = spark.range(1000, numPartitions=7).filter("id % 3 = 0")
    out = surrogate.assign(df, "sk")
    assert sorted(r["sk"] for r in out.collect()) == list(range(1, out.count() + 1))
    assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString()


TIMELINE = {"keys": ["id"], "sequence": "lsn", "tracked": ["v"], "event_ts": "at"}


def versions_of(dim):
    return sorted(((r["id"], r["v"], r[scd2.START], r[scd2.ACTIVE], r[scd2.END]) for r in scd2.versions(dim).collect()), key=str)


@pytest.mark.parametrize("seed, rows_per_task", [(0, 1 << 23), (1, 9)])
def test_splicing_equals_the_history_of_the_whole_log_in_any_order(spark, seed, rows_per_task):
    rnd = random.Random(seed)
    rows = random_log(rnd, 200)
    dealt = [[], [], [], []]
    for r in rows:
        dealt[rnd.randrange(4)].append(r)
    rnd.shuffle(dealt)
    seen, gone = [], F.col("op") == "d"
    dim = scd2.timeline(spark.createDataFrame([], LOG), deleted=gone, **TIMELINE)
    for batch in dealt:
        rnd.shuffle(batch)
        seen += batch
        nameless = [(None, 1, "u", "x", datetime(2024, 1, 1))]
        spliced = scd2.splice(dim, spark.createDataFrame(batch + nameless, LOG), deleted=gone, rows_per_task=rows_per_task, **TIMELINE)
        dim = spark.createDataFrame([tuple(r) for r in spliced.collect()], spliced.schema)
        assert versions_of(dim) == brute_history(seen)
        assert dim.count() == len(seen)
    again = scd2.splice(dim, spark.createDataFrame(dealt[0], LOG), deleted=gone, **TIMELINE)
    assert sorted(map(str, again.collect())) == sorted(map(str, dim.collect()))


def test_splicing_cuts_intervals_and_leaves_other_keys_alone(spark):
    d = [datetime(2024, 1, n) for n in range(1, 10)]
    dim = scd2.timeline(spark.createDataFrame([(1, 10, "u", "a", d[0]), (1, 50, "u", "c", d[5]), (2, 10, "u", "x", d[0])], LOG), **TIMELINE)
    late = spark.createDataFrame([(1, 30, "u", "b", d[3]), (1, 40, "d", None, d[4])], LOG)
    out = scd2.splice(dim, late, deleted=F.col("op") == "d", **TIMELINE)
    assert versions_of(out) == [(1, "a", d[0], False, d[3]), (1, "b", d[3], False, d[4]), (1, "c", d[5], True, OPEN), (2, "x", d[0], True, OPEN)]
    assert sorted(r["record_kind"] for r in out.collect()) == ["delete", "version", "version", "version", "version"]


def test_a_repeated_value_still_ends_what_is_put_in_before_it(spark):
    """a on day 1 and again on day 5 is one version; b of day 3 must end on day 5."""
    d = [datetime(2024, 1, n) for n in range(1, 10)]
    dim = scd2.timeline(spark.createDataFrame([(1, 10, "u", "a", d[0]), (1, 50, "u", "a", d[4])], LOG), **TIMELINE)
    assert versions_of(dim) == [(1, "a", d[0], True, OPEN)]
    out = scd2.splice(dim, spark.createDataFrame([(1, 30, "u", "b", d[2])], LOG), **TIMELINE)
    assert versions_of(out) == [(1, "a", d[0], False, d[2]), (1, "a", d[4], True, OPEN), (1, "b", d[2], False, d[4])]


def test_deletes_close_and_late_changes_are_given_back(spark):
    t, day = datetime(2024, 1, 1), timedelta(days=1)
    dim = spark.createDataFrame([(1, "a", True, t + 5 * day, OPEN), (2, "b", True, t, OPEN), (3, "c", False, t, t + 3 * day)], DIM)
    changes = spark.createDataFrame([
        (1, "x", t + 2 * day, False), (2, None, t + 4 * day, True), (3, "z", t + day, False), (4, None, t, True), (5, "n", t, False), (None, "y", t, False),
    ], "id int, v string, at timestamp_ntz, gone boolean")
    gone = F.col("gone")
    out = scd2.apply_changes(dim, changes, ["id"], ["v"], "at", deleted=gone)
    want = [(1, "a", True, t + 5 * day, OPEN), (2, "b", False, t, t + 4 * day), (3, "c", False, t, t + 3 * day), (5, "n", True, t, OPEN)]
    assert sorted(map(tuple, out.collect())) == want
    assert sorted(r["id"] for r in scd2.late_changes(dim, changes, ["id"], "at").collect()) == [1, 3]
    again = scd2.apply_changes(spark.createDataFrame(want, DIM), changes, ["id"], ["v"], "at", deleted=gone)
    assert sorted(map(tuple, again.collect())) == want


@pytest.mark.parametrize("seed", range(2))
def test_repinning_equals_a_full_point_in_time_join(spark, seed):
    rnd = random.Random(20 + seed)
    rows = random_log(rnd, 250)
    rnd.shuffle(rows)
    gone = F.col("op") == "d"
    old = scd2.timeline(spark.createDataFrame(rows[:200], LOG), deleted=gone, **TIMELINE)
    late = spark.createDataFrame([r for r in rows[200:] if r[0] % 2 == 0], LOG)
    new = scd2.splice(old, late, deleted=gone, **TIMELINE)
    events = spark.createDataFrame(
        [(i, rnd.randint(0, 14), datetime(2024, 1, 1) + timedelta(seconds=rnd.randint(-50, 900_000))) for i in range(500)], "i int, id int, t timestamp_ntz")
    how = (["id"], "t", scd2.START, scd2.END, ["v", "lsn"])
    facts = asof.point_in_time_join(events, scd2.versions(old), *how)
    spans = scd2.changed_spans(scd2.versions(old), scd2.versions(new), ["id"])
    assert all(r["id"] % 2 == 0 for r in spans.collect())
    got = asof.repin(facts, spans, scd2.versions(new), *how)
    want = asof.point_in_time_join(events, scd2.versions(new), *how)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert asof.repinned(facts, spans, scd2.versions(new), *how).count() < 400


def test_a_snapshot_with_null_keys_applied_twice_leaves_the_rows_of_once(spark):
    t, later = datetime(2024, 1, 1), datetime(2024, 2, 1)
    dim = spark.createDataFrame([(1, "a", True, t, OPEN), (None, "old", True, t, OPEN)], DIM)
    source = spark.createDataFrame([(1, "b"), (None, "x"), (None, "y"), (2, "c")], "id int, v string")
    once = scd2.apply_snapshot(dim, source, ["id"], ["v"], F.lit(str(later)))
    twice = scd2.apply_snapshot(once, source, ["id"], ["v"], F.lit(str(later + timedelta(days=1))))
    want = [(1, "a", False, t, later), (1, "b", True, later, OPEN), (2, "c", True, later, OPEN), (None, "old", True, t, OPEN)]
    for out in (once, twice):
        assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_publish_refuses_a_stage_that_repeats_a_key(spark):
    t = datetime(2024, 1, 1)
    stage = spark.createDataFrame([(1, 7, "a", True, t, OPEN), (1, 7, "b", True, t, OPEN)], f"sk long, {DIM}")
    with pytest.raises(ValueError, match="several rows"):
        scd2.publish(stage, stage.limit(0), "sk")


def test_stable_surrogate_keys(spark, tmp_path):
    path, ddl = str(tmp_path / "keys"), "a int, b string, x int"

    def numbers(rows):
        out = surrogate.assign_stable(spark.createDataFrame(rows, ddl), "sk", ["a", "b"], path)
        return sorted(((r["a"], r["b"], r["x"], r["sk"]) for r in out.collect()), key=str)

    first = [(2, "x", 1), (1, "y", 1), (1, "x", 1), (1, "x", 2), (None, "x", 1)]
    once = numbers(first)
    assert {r[:2]: r[3] for r in once} == {(1, "x"): 1, (1, "y"): 2, (2, "x"): 3, (None, "x"): None} and len(once) == 5
    assert numbers(first) == once
    assert {r[:2]: r[3] for r in numbers([(0, "z", 1), (1, "y", 5)])} == {(0, "z"): 4, (1, "y"): 2}
    assert numbers(first) == once and numbers([]) == []
    # keys appended by a load that died before its line in the manifest count for nothing
    spark.createDataFrame([(50, "q", 99)], "a int, b string, sk long").write.parquet(f"{path}/app=keys/batch_id=2")
    assert {r[3] for r in numbers([(50, "q", 0)])} == {5}


def test_slices_that_are_still_too_large_are_cut_again(spark, monkeypatch):
    """More slices than there are cuts in one step, and rows of one order that no cut can part."""
    monkeypatch.setattr(runs, "_CUTS", 4)
    log = spark.range(4000).select(F.when(F.col("id") < 3600, 0).otherwise(F.col("id")).alias("k"),
                                   F.when(F.col("id") % 10 == 0, 77).otherwise(F.col("id")).alias("at"), "id")
    cut = split(log, ["k"], F.col("at"), 60)
    sizes = cut.filter("k = 0").groupBy("__slice").agg(F.count("id").alias("n"), F.min("at").alias("low"), F.max("at").alias("high"))
    rows = sorted((r["__slice"], r["low"], r["high"], r["n"]) for r in sizes.collect())
    assert all(a[2] < b[1] for a, b in zip(rows, rows[1:]))
    assert all(n <= 60 for _, low, high, n in rows if not low <= 77 <= high) and len(rows) > 30
    assert all(n < 500 for _, low, high, n in rows if low <= 77 <= high)         # 361 rows are of order 77
    rows = random_log(random.Random(4), 300, hot=0.8)
    assert spark_history(spark.createDataFrame(rows, LOG), 3) == brute_history(rows)
