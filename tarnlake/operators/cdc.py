"""Change events: envelope, images, change log, current state.

An event carries `op` (c create, r snapshot read, u update, d delete), the row
before and after, and where it came from (sequence number `lsn`, commit time).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tarnlake.operators.latest import latest_by
from tarnlake.operators.merge import Insert, Update, by_key, merge_apply, sizeable, unmatched
from tarnlake.session import staged

# Operation codes and the envelope's field names and types are the wire format.
OPS = ["c", "r", "u", "d"]
SOURCE_DDL = (
    "version string, connector string, name string, ts_ms bigint, snapshot string, db string, sequence string, "
    "ts_us bigint, ts_ns bigint, `schema` string, `table` string, txId bigint, lsn bigint, xmin bigint"
)
TRANSACTION_DDL = "id string, total_order bigint, data_collection_order bigint"


def _struct(ddl: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl


def envelope_schema(row: str | T.StructType) -> T.StructType:
    """Schema of one event for a table with the given row type."""
    image = _struct(row)
    payload = (
        T.StructType()
        .add("before", image)
        .add("after", image)
        .add("source", _struct(SOURCE_DDL))
        .add("transaction", _struct(TRANSACTION_DDL))
        .add("op", T.StringType())
        .add("ts_ms", T.LongType())
        .add("ts_us", T.LongType())
        .add("ts_ns", T.LongType())
    )
    return T.StructType().add("payload", payload)


def parse_events(raw: DataFrame, row: str | T.StructType, value: str = "value") -> DataFrame:
    """Event bytes or text to columns `before`, `after`, `source`, `op`, ... (batch or stream)."""
    text = F.col(value).cast("string")
    parsed = raw.select(F.from_json(text, envelope_schema(row)).alias("event"))
    return parsed.select("event.payload.*")


def flatten(events: DataFrame, separator: str = "__") -> DataFrame:
    """Change-log layout: every field of the images and the source as a column of its own.

    `separator` gives the column names: `before__x`, or `before.x` with a dot.
    """
    columns = []
    for part in ("before", "after", "source"):
        for name in events.schema[part].dataType.names:
            columns.append(F.col(f"{part}.`{name}`").alias(f"{part}{separator}{name}"))
    rest = [c for c in events.columns if c not in ("before", "after", "source", "transaction")]
    return events.select(*columns, *rest)


def normalize(log: DataFrame, fields: Sequence[str], separator: str = "__") -> DataFrame:
    """Typed row image plus tracking columns from a flattened change log.

    The image is chosen as a whole: the row before for a delete, the row after for
    everything else, so an update that sets a column to NULL keeps that NULL.
    """
    def side(part: str, name: str) -> Column:
        return F.col(f"`{part}{separator}{name}`")

    image = [
        F.when(F.col("op") == "d", side("before", f)).otherwise(side("after", f)).alias(f) for f in fields
    ]
    return log.filter(F.col("op").isin(OPS)).select(
        *image,
        "op",
        side("source", "lsn").alias("lsn"),
        side("source", "ts_ms").alias("event_ts_ms"),
        F.timestamp_millis(side("source", "ts_ms")).cast("timestamp_ntz").alias("event_ts"),
    )


def latest_changes(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    return latest_by(changes, keys, sequence)


def to_state(changes: DataFrame, event_ts: str = "event_ts", drop: Sequence[str] = ("op",)) -> DataFrame:
    """Change rows in the shape of the current-state table: `delete_ts` set on deletes."""
    return changes.withColumn("delete_ts", F.when(F.col("op") == "d", F.col(event_ts))).drop(*drop)


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Sequence[str],
    event_ts: str = "event_ts",
    except_columns: Sequence[str] = ("op",),
    stored: bool = False,
) -> DataFrame:
    """Upsert change rows into a current-state table (one row per key, soft deletes).

    Only a change with a higher sequence than the stored row acts (`sequence_by` may list tie-breakers), deletes
    included, so replays and stale events do nothing. A delete leaves a tombstone: `delete_ts`
    is set, the sequence advances, values the event does not carry are kept. A newer
    non-delete clears `delete_ts`. Changes that are `stored` are looked at first: many of them meet the target
    in one join, where the newest of a key lies already.
    """
    sequence = [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)
    newest = latest_changes(changes, keys, sequence)
    source = newest.withColumn("delete_ts", F.when(F.col("op") == "d", F.col(event_ts)))
    fields = [c for c in target.columns if c in source.columns and c not in except_columns]
    values = {c: F.col(f"source.`{c}`") for c in fields}
    newer = F.struct(*[F.col(f"source.{c}") for c in sequence]) > F.struct(*[F.col(f"target.{c}") for c in sequence])
    kept = {c: F.coalesce(F.col(f"source.`{c}`"), F.col(f"target.`{c}`")) for c in fields}
    return merge_apply(
        target,
        source,
        keys,
        matched=[Update(kept, when=newer & (F.col("source.op") == "d")), Update(values, when=newer)],
        not_matched=[Insert(values)],
        unique_source=True,
        stage=True,
        together=stored and sizeable(changes, keys),
    )


def out_of_order(changes: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updates and deletes whose key neither the target nor an insert of the batch brings in."""
    inserted = changes.filter(F.col("op").isin("c", "r")).select(*keys).distinct()
    late, loose = by_key(changes.filter(F.col("op").isin("u", "d")), keys)
    # the batch's own inserts first: what is left for the target to answer is small
    missing = late.join(inserted, list(keys), "left_anti").select(*changes.columns)
    return unmatched(missing, target, keys).unionByName(loose)


def apply_with_quarantine(
    target: DataFrame,
    quarantined: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Sequence[str],
    event_ts: str = "event_ts",
) -> tuple[DataFrame, DataFrame]:
    """Upsert a batch together with the events put aside earlier; returns the new state and what is put aside now.

    An event whose key neither the state nor an insert among these events brings in waits; when the insert comes, the waiting events of its
    key act with it by sequence, so whatever the batches were, the state is that of all events of the keys inserted so far. Events without a full key
    wait for good. The events and the keys that have a base row are written when this is called.
    """
    keys = list(keys)
    full, loose = by_key(staged(with_retry(changes, quarantined), "incoming-events"), keys)
    inserted = full.filter(F.col("op").isin("c", "r")).select(*keys).distinct()
    others = full.select(*keys).distinct().join(inserted, keys, "left_anti")
    present = target.select(*keys).join(others, keys, "left_semi")
    based = staged(inserted.unionByName(present.distinct()), "based-keys")
    state = apply_changes(target, full.join(based, keys, "left_semi").select(*full.columns), keys, sequence_by, event_ts)
    return state, full.join(based, keys, "left_anti").select(*full.columns).unionByName(loose)


def with_retry(changes: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Incoming events together with those put aside earlier."""
    return changes.unionByName(quarantined, allowMissingColumns=True)
