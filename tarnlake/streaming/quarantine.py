"""Current state with a quarantine: events that come before their row wait in a table of their own, from run to run."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tarnlake.operators import cdc
from tarnlake.operators.latest import latest_by
from tarnlake.sources import snapshots


def upsert(
    path: str, keys: Sequence[str], sequence_by: str | Sequence[str], clock: Callable[[], datetime], event_ts: str = "event_ts"
) -> Callable[[DataFrame, int], None]:
    """Batch writer that keeps a state and a quarantine below `path`, for `events.start` or for batches by hand.

    The quarantine is written first and the state's commit names its version and the batch, so both move on with that one commit: a
    writer that dies in between leaves the state and the quarantine as they were. Batches come in the order of their numbers; one that is met again is passed over.
    """
    order = [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, commit = batch.sparkSession, snapshots.last(batch.sparkSession, f"{path}/state")
        if commit is None:
            target, waiting = cdc.to_state(latest_by(batch.limit(0), list(keys), order), event_ts), batch.limit(0)
        elif json.loads(commit["note"])["batch"] >= batch_id:
            return
        else:
            target, waiting = snapshots.read(spark, f"{path}/state", commit["version"]), held(spark, path)
        state, rest = cdc.apply_with_quarantine(target, waiting, batch, keys, sequence_by, event_ts)
        version = snapshots.write(rest, f"{path}/quarantine", "hold", clock(), note=str(batch_id))
        snapshots.write(state, f"{path}/state", "apply", clock(), note=json.dumps({"batch": batch_id, "quarantine": version}))

    return write


def current(spark: SparkSession, path: str) -> DataFrame:
    """The state after the batches so far."""
    return snapshots.read(spark, f"{path}/state")


def held(spark: SparkSession, path: str) -> DataFrame:
    """The events that wait, as of the state's newest commit."""
    note = json.loads(snapshots.last(spark, f"{path}/state")["note"])
    return snapshots.read(spark, f"{path}/quarantine", note["quarantine"])
