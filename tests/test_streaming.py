"""Streams: replays, several batches, folding, sinks."""

import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import cdc
from tarnlake.operators.latest import latest_by
from tarnlake.plans.changes import ROW_DDL, event_stream
from tarnlake.plans.inputs import Tables, change_log
from tarnlake.streaming import events as streams


def land(spark, sf_dir, path, files=6):
    t = Tables(spark, sf_dir)
    event_stream(t.events).repartition(files).select(F.to_json(F.struct("value"))).write.mode("append").text(path)
    return t


def flat(spark, path):
    return cdc.flatten(cdc.parse_events(streams.read_files(spark, path, max_files=2), ROW_DDL))


def test_a_lost_commit_is_replayed_without_duplicates(spark, sf_dir, tmp_path):
    landing, log, checkpoint = (str(tmp_path / n) for n in ("landing", "log", "checkpoint"))
    t = land(spark, sf_dir, landing)
    n = t.events.count()

    def run():
        streams.drain(streams.start(flat(spark, landing), streams.append_once(log, "a"), checkpoint, every=None))
        return streams.read_log(spark, log)

    first = run()
    assert first.count() == n and first.select("batch_id").distinct().count() == 3
    commits = sorted(int(f) for f in os.listdir(f"{checkpoint}/commits") if f.isdigit())
    for name in (f"{commits[-1]}", f".{commits[-1]}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")
    again = run()
    assert again.count() == n
    assert again.select("source__lsn").distinct().count() == n


def test_upserts_over_many_batches_with_a_fold_between(spark, sf_dir, tmp_path):
    landing, state, checkpoint = (str(tmp_path / n) for n in ("landing", "state", "checkpoint"))

    def run():
        rows = cdc.normalize(flat(spark, landing), ["id", "state"])
        query = streams.start(rows.drop("event_ts_ms"), streams.upsert(state, ["id"], "lsn"), checkpoint, every=None)
        streams.drain(query)

    t = land(spark, sf_dir, landing)
    run()
    assert streams.fold(spark, state, ["id"], "lsn", datetime(2024, 2, 1)) == 0
    land(spark, sf_dir, landing, 2)                      # the same events again: nothing may change
    run()
    got = streams.current_state(spark, state, ["id"], "lsn")
    want = latest_by(change_log(t.events), ["id"], ["lsn"])
    assert sorted((r["id"], r["state"], r["lsn"], r["delete_ts"] is not None) for r in got.collect()) == sorted(
        (r["id"], r["state"], r["lsn"], r["op"] == "d") for r in want.collect()
    )
    assert streams.fold(spark, state, ["id"], "lsn", datetime(2024, 2, 2)) == 1


def test_json_sink_appends_once(spark, sf_dir, tmp_path):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("landing", "out", "checkpoint"))
    t = land(spark, sf_dir, landing)
    for _ in range(2):
        streams.drain(streams.append_json(flat(spark, landing).select("source__lsn", "op"), out, checkpoint))
    assert spark.read.json(out).count() == t.events.count()


def test_a_state_read_during_a_fold_is_complete(spark, tmp_path, monkeypatch):
    """A fold that commits while a state is being put together must not hide batches from it."""
    state = str(tmp_path / "state")
    write = streams.upsert(state, ["id"], ["lsn", "part"])

    def batch(number, rows):
        write(spark.createDataFrame([(*r, "u", datetime(2024, 1, 1)) for r in rows],
                                    "id int, state string, lsn long, part int, op string, event_ts timestamp_ntz"), number)

    batch(0, [(1, "a", 1, 0), (2, "a", 1, 0)])
    streams.fold(spark, state, ["id"], ["lsn", "part"], datetime(2024, 2, 1))
    batch(1, [(1, "b", 2, 0), (1, "c", 2, 1), (3, "a", 2, 0)])
    batch(2, [(2, "b", 3, 0)])
    real, folded = streams.snapshots.last, []

    def last_then_fold(*args):
        found = real(*args)
        if not folded:
            folded.append(True)
            streams.fold(spark, state, ["id"], ["lsn", "part"], datetime(2024, 2, 2))
        return found

    monkeypatch.setattr(streams.snapshots, "last", last_then_fold)
    got = streams.current_state(spark, state, ["id"], ["lsn", "part"])
    assert folded and sorted((r["id"], r["state"]) for r in got.collect()) == [(1, "c"), (2, "b"), (3, "a")]
    monkeypatch.undo()
    streams.fold(spark, state, ["id"], ["lsn", "part"], datetime(2024, 2, 3))
    assert not [f for f in os.listdir(f"{state}/delta") if f.startswith("batch_id=")]
    got = streams.current_state(spark, state, ["id"], ["lsn", "part"])
    assert sorted((r["id"], r["state"]) for r in got.collect()) == [(1, "c"), (2, "b"), (3, "a")]


def test_readers_take_finished_batches_only(spark, tmp_path):
    path = str(tmp_path / "log")
    with pytest.raises(ValueError, match="no batch"):
        streams.read_log(spark, path)
    write = streams.append_once(path, "a")
    write(spark.createDataFrame([(1, "x")], "id int, v string"), 0)
    write(spark.createDataFrame([(2, "y", 5)], "id int, v string, more int"), 1)
    streams.append_once(path, "b")(spark.createDataFrame([(3, "z")], "id int, v string"), 0)
    # a batch that was being written when its writer died: all its files are there, but not its line in the manifest
    spark.createDataFrame([(9, "lost")], "id int, v string").write.parquet(f"{path}/app=a/batch_id=2")
    got = sorted((r["id"], r["more"], r["app"], r["batch_id"]) for r in streams.read_log(spark, path).collect())
    assert got == [(1, None, "a", 0), (2, 5, "a", 1), (3, None, "b", 0)]
    write(spark.createDataFrame([(4, "w")], "id int, v string"), 2)
    assert sorted(r["id"] for r in streams.read_log(spark, path).collect()) == [1, 2, 3, 4]


def test_console_and_processing_time(spark, sf_dir, tmp_path):
    landing = str(tmp_path / "landing")
    n = land(spark, sf_dir, landing).events.count()
    shown = streams.console(streams.read_files(spark, landing), str(tmp_path / "c1"), every=None)
    streams.drain(shown)
    assert sum(p["numInputRows"] for p in shown.recentProgress) == n
    counted = []
    running = streams.start(streams.read_files(spark, landing, max_files=2), lambda batch, i: counted.append(batch.count()), str(tmp_path / "c2"), every="1 second")
    deadline = time.time() + 60
    while sum(counted) < n and time.time() < deadline:
        time.sleep(0.5)
    running.stop()
    assert sum(counted) == n and len(counted) == 3
    with pytest.raises(TimeoutError):
        streams.drain(streams.start(streams.read_files(spark, landing), lambda batch, i: None, str(tmp_path / "c3"), every="1 second"), timeout=3)


def test_console_prints_the_first_rows_of_each_batch(spark, sf_dir, tmp_path, capsys):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    land(spark, sf_dir, landing, files=3)
    rows = flat(spark, landing).select("source__lsn", "op")
    streams.drain(streams.console(rows, checkpoint, every=None, n=2, order="source__lsn"))
    printed = capsys.readouterr().out
    assert printed.count("batch ") == 2                      # two files per batch
    assert sum(line.startswith("|") for line in printed.splitlines()) == 2 * (1 + 2)


def test_shown_hands_over_no_more_than_it_prints(spark, capsys):
    got = []
    write = streams.shown(3, "n", then=lambda first, i: got.append((i, [r["n"] for r in first.collect()])))
    write(spark.range(100).selectExpr("99 - id as n"), 7)
    write(spark.range(0).selectExpr("id as n"), 8)
    assert got == [(7, [0, 1, 2]), (8, [])]
    assert capsys.readouterr().out.count("batch ") == 2


def test_a_running_stream_takes_what_lands_and_raises_its_errors(spark, sf_dir, tmp_path):
    landing, log, checkpoint = (str(tmp_path / n) for n in ("landing", "log", "checkpoint"))
    n = land(spark, sf_dir, landing, files=1).events.count()
    query = streams.start(flat(spark, landing), streams.append_once(log, "a"), checkpoint, every="100 milliseconds")
    try:
        streams.catch_up(query)
        assert query.isActive and streams.read_log(spark, log).count() == n
        land(spark, sf_dir, landing, files=1)
        streams.catch_up(query)
        assert streams.read_log(spark, log).count() == 2 * n
    finally:
        query.stop()

    def fail(batch, batch_id):
        raise RuntimeError("cannot write")

    broken = streams.start(flat(spark, landing), fail, str(tmp_path / "other"), every="100 milliseconds")
    with pytest.raises(Exception, match="cannot write"):
        streams.catch_up(broken)


def test_source_options_pass_through(spark, sf_dir, tmp_path):
    landing, log, checkpoint = (str(tmp_path / n) for n in ("landing", "log", "checkpoint"))
    n = land(spark, sf_dir, f"{landing}/a/b", files=2).events.count()
    (tmp_path / "landing" / "notes.csv").write_text("not an event\n")
    found = streams.read_files(spark, landing, options={"recursiveFileLookup": "true", "pathGlobFilter": "*.txt"})
    streams.drain(streams.start(found, streams.append_once(log, "a"), checkpoint, every=None))
    assert streams.read_log(spark, log).count() == n
