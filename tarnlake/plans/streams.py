"""Change streams over the whole event log, landed as JSON lines by Spark."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tarnlake.functions import decode_decimal
from tarnlake.operators import cdc
from tarnlake.plans.changes import ROW_DDL, event_stream
from tarnlake.plans.inputs import CHANGE_LOG, Tables, ints_as_text
from tarnlake.session import work_path
from tarnlake.streaming import events as streams

_FIELDS = ["id", "state", "amount", "modified"]


def _land(t: Tables, rows: DataFrame, path: str | None = None) -> str:
    path = path or work_path(t.spark, "landing")
    event_stream(rows).select(F.to_json(F.struct("value")).alias("line")).write.mode("append").text(path)
    return path


def _stream(t: Tables, path: str, **how) -> DataFrame:
    return cdc.parse_events(streams.read_files(t.spark, path, **how), ROW_DDL)


def _changes(t: Tables, path: str) -> DataFrame:
    rows = cdc.normalize(cdc.flatten(_stream(t, path)), _FIELDS)
    return rows.withColumn("amount", decode_decimal(F.col("amount"), 2).cast("double")).select(
        "id", "state", "amount", "op", "lsn", "event_ts"
    )


def _ingested(t: Tables, write_twice: bool = False) -> DataFrame:
    log, checkpoint = work_path(t.spark, "log"), work_path(t.spark, "checkpoint")
    once = streams.append_once(log, "ingest")

    def replayed(batch: DataFrame, batch_id: int) -> None:
        once(batch, batch_id)
        if write_twice:  # the replay a restart causes when the batch was not committed
            once(batch, batch_id)

    flat = cdc.flatten(_stream(t, _land(t, t.events)))
    streams.drain(streams.start(flat, replayed, checkpoint, every=None))
    return _logged(t, log)


def _logged(t: Tables, log: str) -> DataFrame:
    return streams.read_log(t.spark, log).select(
        "before__id", "after__id", "after__state", "source__lsn", "source__ts_ms", "op"
    )


def _json_sink(t: Tables) -> DataFrame:
    out, checkpoint = work_path(t.spark, "json"), work_path(t.spark, "checkpoint")
    flat = cdc.flatten(_stream(t, _land(t, t.events))).select("after__id", "source__lsn", "op")
    streams.drain(streams.append_json(flat, out, checkpoint))
    return t.spark.read.schema("after__id bigint, source__lsn bigint, op string").json(out)


def _upserted(t: Tables) -> DataFrame:
    """Events land in two drops, out of order; the state is folded between them."""
    landing, state, checkpoint = (work_path(t.spark, n) for n in ("landing", "state", "checkpoint"))

    def drop(kinds: list[str]) -> None:
        _land(t, t.events.filter(F.col("event_type").isin(kinds)), landing)
        streams.drain(streams.start(_changes(t, landing), streams.upsert(state, ["id"], "lsn"), checkpoint, every=None))

    drop(["signup", "error", "view"])
    streams.fold(t.spark, state, ["id"], "lsn", datetime(2024, 2, 1))
    drop(["click", "purchase"])
    return streams.current_state(t.spark, state, ["id"], "lsn")


_EARLY = ["signup", "error", "view"]


def _with_options(t: Tables) -> DataFrame:
    """Events in folders by kind next to files of another kind: source options find the ones and pass over the others."""
    landing, log, checkpoint = (work_path(t.spark, n) for n in ("landing", "log", "checkpoint"))
    early = F.col("event_type").isin(_EARLY)
    _land(t, t.events.filter(early), f"{landing}/first/drop")
    _land(t, t.events.filter(~early), f"{landing}/second/drop")
    t.events.write.json(f"{landing}/other", compression="gzip")
    found = _stream(t, landing, options={"recursiveFileLookup": "true", "pathGlobFilter": "*.txt"})
    streams.drain(streams.start(cdc.flatten(found), streams.append_once(log, "options"), checkpoint, every=None))
    return _logged(t, log)


def _while_running(t: Tables) -> DataFrame:
    """A stream on a processing-time trigger takes two drops that land while it runs, then is stopped."""
    landing, log, checkpoint = (work_path(t.spark, n) for n in ("landing", "log", "checkpoint"))
    early = F.col("event_type").isin(_EARLY)
    _land(t, t.events.filter(early), landing)
    query = streams.start(cdc.flatten(_stream(t, landing)), streams.append_once(log, "running"), checkpoint, every="100 milliseconds")
    try:
        streams.catch_up(query)
        _land(t, t.events.filter(~early), landing)
        streams.catch_up(query)
    finally:
        query.stop()
    return _logged(t, log)


_LIMIT = 3


def _limited(t: Tables) -> DataFrame:
    """Eight files and more, three per micro-batch: what each batch took, put together."""
    landing, log, checkpoint = (work_path(t.spark, n) for n in ("landing", "log", "checkpoint"))
    _land(t, t.events.repartition(max(8, t.spark.sparkContext.defaultParallelism)), landing)
    rows = streams.read_files(t.spark, landing, max_files=_LIMIT).select(F.col("_metadata.file_name").alias("file_name"))
    streams.drain(streams.start(rows, streams.append_once(log, "limited"), checkpoint, every=None))
    batches = streams.read_log(t.spark, log).groupBy("batch_id", "file_name").agg(F.count(F.lit(1)).alias("n_rows")).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("files"), F.sum("n_rows").alias("n_rows"))
    return batches.agg(F.sum("n_rows").alias("n_rows"), (F.max("files") <= _LIMIT).alias("within_limit"),
                       (F.count(F.lit(1)) > 1).alias("several_batches"))


def _console(t: Tables) -> DataFrame:
    """The first twenty changes by sequence number of a micro-batch, printed, and kept to be looked at."""
    seen, checkpoint = work_path(t.spark, "seen"), work_path(t.spark, "checkpoint")
    writer = streams.shown(20, "source__lsn", then=streams.append_once(seen, "console"))
    flat = cdc.flatten(_stream(t, _land(t, t.events))).select("after__id", "source__lsn", "op")
    streams.drain(streams.start(flat, writer, checkpoint, every=None))
    return streams.read_log(t.spark, seen).select("after__id", "source__lsn", "op")


QUERIES = {
    "stream_cdc_ingest": _ingested,
    "stream_idempotent_append": lambda t: _ingested(t, write_twice=True),
    "stream_json_sink": _json_sink,
    "stream_cdc_upsert": _upserted,
    "stream_options": _with_options,
    "stream_processing_time": _while_running,
    "stream_rate_limit": _limited,
    "stream_console": _console,
}

_LOG = f"""select case when op in ('u', 'd') then id end as before__id, case when op <> 'd' then id end as after__id,
  case when op <> 'd' then state end as after__state, lsn as source__lsn,
  epoch_us(event_ts) // 1000 as source__ts_ms, op from {CHANGE_LOG}"""
_MILLIS = "make_timestamp(epoch_us(event_ts) // 1000 * 1000)"
ORACLE = {
    "stream_cdc_ingest": _LOG,
    "stream_idempotent_append": _LOG,
    "stream_json_sink": f"select case when op <> 'd' then id end as after__id, lsn as source__lsn, op from {CHANGE_LOG}",
    "stream_options": _LOG,
    "stream_processing_time": _LOG,
    "stream_rate_limit": "select count(*) as n_rows, true as within_limit, true as several_batches from events",
    "stream_console": f"""select case when op <> 'd' then id end as after__id, lsn as source__lsn, op from {CHANGE_LOG}
  order by lsn limit 20""",
    "stream_cdc_upsert": f"""select id, state, amount, lsn, {_MILLIS} as event_ts,
    case when op = 'd' then {_MILLIS} end as delete_ts
  from (select *, row_number() over (partition by id order by lsn desc) as rn from {CHANGE_LOG}) where rn = 1""",
}

for _name in ("stream_cdc_ingest", "stream_idempotent_append", "stream_options", "stream_processing_time"):
    QUERIES[_name], ORACLE[_name] = ints_as_text(QUERIES[_name], ORACLE[_name], "before__id", "after__id")
for _name in ("stream_json_sink", "stream_console"):
    QUERIES[_name], ORACLE[_name] = ints_as_text(QUERIES[_name], ORACLE[_name], "after__id")
