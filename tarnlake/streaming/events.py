"""Streams of change events: read, parse, append once, upsert."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tarnlake.operators import cdc
from tarnlake.operators.latest import latest_by
from tarnlake.session import remove
from tarnlake.sinks import files as sinks
from tarnlake.sources import snapshots
from tarnlake.sources.files import head

TRIGGER = "15 seconds"


def read_topic(spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Broker topic as a stream of `value` bytes; needs the broker package on the classpath.

    `options` pass through (TLS material, `failOnDataLoss`, `maxOffsetsPerTrigger`, ...). A micro-batch takes all there is unless
    a limit is given.
    """
    given = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", **(options or {})}
    return spark.readStream.format("kafka").options(**given).load().select("value")


def read_files(
    spark: SparkSession, path: str, max_files: int | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """The same stream from JSON lines `{"value": "..."}` landing in a folder, `max_files` per micro-batch if given.

    `options` pass through (`recursiveFileLookup`, `pathGlobFilter`, `maxFileAge`, ...).
    """
    reader = spark.readStream.format("json").schema("value string").options(**(options or {}))
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).load(path)


def start(
    stream: DataFrame, write_batch: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = TRIGGER
) -> StreamingQuery:
    """Run `write_batch` on every micro-batch; `every=None` drains what is there and stops."""
    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def append_once(path: str, app: str) -> Callable[[DataFrame, int], None]:
    """Batch writer that leaves one copy of a batch however often it is replayed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.append_batch(batch, path, app, batch_id)

    return write


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Change log written by `append_once`, with `app` and `batch_id`: the batches that were finished."""
    log = sinks.read_batches(spark, path)
    if log is None:
        raise ValueError(f"no batch has been finished in {path}")
    return log


def append_json(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once JSON file sink, append mode."""
    return (
        stream.writeStream.format("json").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def shown(
    n: int = 20, order: str | Sequence[str] = (), then: Callable[[DataFrame, int], None] | None = None
) -> Callable[[DataFrame, int], None]:
    """Batch writer that prints the first rows of each micro-batch, in an order or as they lie, and hands them to `then`.

    The whole batch is read, so the progress of the stream counts all its rows, but a task keeps `n` of them and at most `n` come to
    the driver; Spark's own console format fetches the whole batch before it cuts it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        by = [*_order(order), "__at"]
        first = head(batch.withColumn("__at", F.monotonically_increasing_id()), n, *by).drop("__at")
        print(f"batch {batch_id}")
        first.show(n, truncate=False)
        if then is not None:
            then(first, batch_id)

    return write


def console(
    stream: DataFrame, checkpoint: str, every: str | None = TRIGGER, n: int = 20, order: str | Sequence[str] = ()
) -> StreamingQuery:
    """Print the first rows of each micro-batch; `every=None` prints what is there and stops."""
    return start(stream, shown(n, order), checkpoint, every)


def _order(sequence_by: str | Sequence[str]) -> list[str]:
    return [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)


def upsert(path: str, keys: Sequence[str], sequence_by: str | Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Batch writer that keeps a current-state table in step with the stream.

    A batch leaves only its own net changes (newest row per key; `sequence_by` may list tie-breakers), so its cost follows
    the batch and not the table; `current_state` lays them over the last folded base
    and `fold` moves them into a new one.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        net = latest_by(batch, list(keys), _order(sequence_by))
        net.write.mode("overwrite").parquet(f"{path}/delta/batch_id={batch_id}")

    return write


def _deltas(spark: SparkSession, path: str, after: int) -> DataFrame | None:
    """Net changes of the batches after one, or None where there are none. Only their folders are read."""
    later = sorted(i for i in _batches(spark, path) if i > after)
    return spark.read.option("basePath", f"{path}/delta").parquet(
        *(f"{path}/delta/batch_id={i}" for i in later)).drop("batch_id") if later else None


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the batches with a complete folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/delta")
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        return []
    folders = [f.getPath() for f in system.listStatus(where) if f.getPath().getName().startswith("batch_id=")]
    done = [f for f in folders if system.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
    return [int(f.getName().split("=")[1]) for f in done]


def current_state(spark: SparkSession, path: str, keys: Sequence[str], sequence_by: str | Sequence[str]) -> DataFrame:
    """State after all batches written so far.

    Changes act by sequence, so batches that arrive in any order, or are met again
    after a fold, lead to the same rows. The base and the last batch it holds come from one commit, so a fold that
    commits meanwhile changes nothing.
    """
    return _state(spark, path, keys, sequence_by)[0]


def _state(spark: SparkSession, path: str, keys: Sequence[str], sequence_by: str | Sequence[str]) -> tuple[DataFrame, int]:
    commit = snapshots.last(spark, f"{path}/base")
    upto = -1 if commit is None else int(commit["note"])
    batches = _batches(spark, path)
    later = _deltas(spark, path, upto)
    newest = max([upto, *batches])
    if commit is None:
        if later is None:
            raise ValueError(f"no batch has been written to {path}")
        return cdc.to_state(latest_by(later, list(keys), _order(sequence_by))), newest
    base = snapshots.read(spark, f"{path}/base", commit["version"])
    return (base if later is None else cdc.apply_changes(base, later, keys, sequence_by)), newest


def fold(spark: SparkSession, path: str, keys: Sequence[str], sequence_by: str | Sequence[str], at: datetime) -> int:
    """Write the current state as a new base; later reads skip the batches in it.

    Folders of batches that the base before this one held already are removed: whoever reads that base now
    does not look at them.
    """
    before = snapshots.last(spark, f"{path}/base")
    state, upto = _state(spark, path, keys, sequence_by)
    version = snapshots.write(state, f"{path}/base", "fold", at, note=str(upto))
    if before is not None:
        for i in _batches(spark, path):
            if i <= int(before["note"]):
                remove(spark, f"{path}/delta/batch_id={i}")
    return version


def drain(query: StreamingQuery, timeout: int | None = None) -> None:
    """Wait for a stream that stops by itself; where a time limit is given, stop it when the time is up."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError("stream did not finish in time")


def catch_up(query: StreamingQuery) -> None:
    """Wait until a running stream has taken all that has landed; the stream goes on. What makes it fail is raised here."""
    query.processAllAvailable()
