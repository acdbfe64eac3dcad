"""Edge cases of applying change events to a current-state table."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import cdc
from tarnlake.operators.latest import latest_by
from tarnlake.streaming import quarantine

CHANGES = "id int, name string, bal double, op string, lsn long, event_ts timestamp_ntz"
STATE = "id int, name string, bal double, lsn long, event_ts timestamp_ntz, delete_ts timestamp_ntz"
T0 = datetime(2024, 1, 1)


def at(n):
    return T0 + timedelta(seconds=n)


def event(id, name, bal, op, lsn):
    return (id, name, bal, op, lsn, at(lsn))


def apply(spark, state, events):
    out = cdc.apply_changes(
        spark.createDataFrame(state, STATE), spark.createDataFrame(events, CHANGES), ["id"], "lsn"
    )
    return {r["id"]: tuple(r) for r in out.collect()}


def row(id, name, bal, lsn, deleted=None):
    return (id, name, bal, lsn, at(lsn), None if deleted is None else at(deleted))


def test_bulk_update(spark):
    state = [row(i, "s", 10.0, 1) for i in range(5)]
    got = apply(spark, state, [event(i, "s", 110.0, "u", 10 + i) for i in range(5)])
    assert got == {i: row(i, "s", 110.0, 10 + i) for i in range(5)}


def test_insert_then_delete_leaves_a_tombstone(spark):
    got = apply(spark, [], [event(1, "new", 2049.4, "c", 5), event(1, "new", 2049.4, "d", 6)])
    assert got == {1: row(1, "new", 2049.4, 6, 6)}


def test_insert_update_delete(spark):
    events = [event(2, "n", 2024.56, "c", 5), event(2, "n", 1924.56, "u", 6), event(2, "n", 1924.56, "d", 7)]
    assert apply(spark, [], events) == {2: row(2, "n", 1924.56, 7, 7)}


def test_replay_and_stale_events_change_nothing(spark):
    state = [row(1, "a", 1.0, 10)]
    for e in (event(1, "old", 0.0, "u", 9), event(1, "old", 0.0, "d", 9), event(1, "a", 1.0, "u", 10)):
        assert apply(spark, state, [e]) == {1: state[0]}


def test_delete_keeps_values_the_event_does_not_carry(spark):
    assert apply(spark, [row(1, "a", 1.0, 1)], [event(1, None, None, "d", 2)]) == {1: row(1, "a", 1.0, 2, 2)}


def test_insert_after_delete_revives(spark):
    assert apply(spark, [row(1, "a", 1.0, 5, 5)], [event(1, "b", 2.0, "c", 6)]) == {1: row(1, "b", 2.0, 6)}


def test_update_to_null_is_kept(spark):
    assert apply(spark, [row(1, "a", 1.0, 1)], [event(1, None, 2.0, "u", 2)]) == {1: row(1, None, 2.0, 2)}


@pytest.mark.parametrize("seed", range(2))
def test_any_batching_of_the_log_gives_the_same_state(spark, seed):
    rnd = random.Random(seed)
    events = [event(rnd.randint(0, 9), rnd.choice("abc"), float(rnd.randint(0, 5)), rnd.choice("cud"), n)
              for n in range(60)]
    log = spark.createDataFrame(events, CHANGES)
    want = {r["id"]: tuple(r) for r in cdc.to_state(latest_by(log, ["id"], ["lsn"])).select(
        "id", "name", "bal", "lsn", "event_ts", "delete_ts").collect()}
    rnd.shuffle(events)
    state = spark.createDataFrame([], STATE)
    for part in (events[:20], events[10:45], events[40:], events[:60]):  # overlapping: replays
        got = apply(spark, [tuple(r) for r in state.collect()], part)
        state = spark.createDataFrame(list(got.values()), STATE)
    assert got == want


def test_out_of_order(spark):
    events = [event(1, "a", 1.0, "u", 1), event(2, "a", 1.0, "c", 2), event(2, "b", 1.0, "u", 3),
              event(3, "c", 1.0, "d", 4), event(4, "d", 1.0, "u", 5), event(None, "e", 1.0, "u", 6)]
    target = spark.createDataFrame([row(4, "d", 1.0, 0)], STATE)
    late = cdc.out_of_order(spark.createDataFrame(events, CHANGES), target, ["id"])
    assert {r["id"] for r in late.collect()} == {1, 3, None}


def test_envelope_with_schema_part(spark):
    text = ('{"schema": {"type": "struct"}, "payload": {"before": null, "after": {"id": 7, "name": "x"}, '
            '"source": {"lsn": 12, "ts_ms": 1700000000123, "table": "t"}, "op": "c", "ts_ms": 1700000000456}}')
    raw = spark.createDataFrame([(bytearray(text, "utf8"),)], "value binary")
    flat = cdc.flatten(cdc.parse_events(raw, "id int, name string"))
    out = cdc.normalize(flat, ["id", "name"]).first()
    assert (out["id"], out["name"], out["op"], out["lsn"]) == (7, "x", "c", 12)
    assert out["event_ts"] == datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert "before__id" in flat.columns and "source__txId" in flat.columns
    assert cdc.flatten(cdc.parse_events(raw, "id int, name string"), ".").select(F.col("`after.id`")).first()[0] == 7


def brute_quarantine(events):
    """State by the ordered log of the keys that were ever inserted, and the events of the others."""
    based = {e[0] for e in events if e[3] in "cr" and e[0] is not None}
    last, rest = {}, []
    for e in sorted(events, key=lambda e: e[4]):
        if e[0] in based:
            last[e[0]] = e
        else:
            rest.append(e[4])
    return {k: (e[4], e[3] == "d") for k, e in last.items()}, sorted(rest)


@pytest.mark.parametrize("seed", range(2))
def test_events_wait_over_batches_until_their_row_comes(spark, tmp_path, seed):
    rnd, path = random.Random(seed), str(tmp_path / "q")
    events = [event(rnd.choice([None, *range(12)]), "n", 1.0, rnd.choice("cuuuudddr"), n) for n in range(60)]
    dealt = [[], [], []]
    for e in events:
        dealt[rnd.randrange(3)].append(e)
    write, seen = quarantine.upsert(path, ["id"], "lsn", lambda: T0), []
    for number, batch in enumerate(dealt):
        seen += batch
        write(spark.createDataFrame(batch, CHANGES), number)
        state, rest = brute_quarantine(seen)
        assert {r["id"]: (r["lsn"], r["delete_ts"] is not None) for r in quarantine.current(spark, path).collect()} == state
        assert sorted(r["lsn"] for r in quarantine.held(spark, path).collect()) == rest
    write(spark.createDataFrame(dealt[2], CHANGES), 2)                       # met again
    assert quarantine.current(spark, path).count() == len(state) and quarantine.held(spark, path).count() == len(rest)


def test_a_writer_that_dies_between_quarantine_and_state_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "q")
    write = quarantine.upsert(path, ["id"], "lsn", lambda: T0)
    write(spark.createDataFrame([event(1, "a", 1.0, "c", 1), event(2, "b", 1.0, "u", 2)], CHANGES), 0)
    real = quarantine.snapshots.write

    def dies(df, where, *args, **kwargs):
        if where.endswith("/state"):
            raise RuntimeError("lost")
        return real(df, where, *args, **kwargs)

    batch = spark.createDataFrame([event(2, "b", 1.0, "c", 3), event(3, "x", 1.0, "d", 4)], CHANGES)
    monkeypatch.setattr(quarantine.snapshots, "write", dies)
    with pytest.raises(RuntimeError):
        write(batch, 1)
    monkeypatch.undo()
    assert [r["lsn"] for r in quarantine.held(spark, path).collect()] == [2]
    write(batch, 1)
    assert sorted((r["id"], r["lsn"]) for r in quarantine.current(spark, path).collect()) == [(1, 1), (2, 3)]
    assert [r["lsn"] for r in quarantine.held(spark, path).collect()] == [4]
