"""Spark session set-up and the shared work area."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every query of this package expects.
#  - UTC, so timestamps mean the same in every engine the results are compared with;
#  - AQE splits skewed join partitions even where that costs one more exchange;
#  - Python workers get few rows at a time, as rows may hold long texts;
#  - a task writes a few folders side by side, so that rows that lie in folders by kind need no sort.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


STORED_CODEC = "zstd"          # of staged tables and layers, which are most of what a query writes
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tarnlake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the runtime settings; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def job_parameter(spark: SparkSession, name: str, default: str | None = None) -> str | None:
    """Job parameter handed over as a session setting (`spark.app.<name>`)."""
    return spark.conf.get(f"spark.app.{name}", default)


@contextmanager
def job_parameters(spark: SparkSession, **given: str) -> Iterator[None]:
    """Job parameters for the block; what was set before is set again when it ends."""
    before = {name: job_parameter(spark, name) for name in given}
    for name, value in given.items():
        spark.conf.set(f"spark.app.{name}", value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(f"spark.app.{name}")
            else:
                spark.conf.set(f"spark.app.{name}", value)


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: the one named by the cluster.

    A machine-local folder is accepted only when driver and executors are the
    same process (local mode, as in tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tarnlake-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


class _Scopes(threading.local):
    """The `staging` blocks a thread is in."""

    def __init__(self) -> None:
        self.open: list[list[str]] = []


_SCOPES = _Scopes()


def work_path(spark: SparkSession, label: str, keep: bool = False) -> str:
    """Fresh path below the shared folder. It belongs to the thread's innermost `staging` block, if there is one and unless it is to `keep`."""
    path = f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _SCOPES.open and not keep:
        _SCOPES.open[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a work path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Owner of what is staged inside the block: it is deleted when the block ends.

    Results that read staged tables must be written before that, to a path made outside. Without a block staged tables stay until
    the shared folder is cleaned.
    """
    mine: list[str] = []
    _SCOPES.open.append(mine)
    try:
        yield
    finally:
        _SCOPES.open.pop()
        for path in mine:
            remove(spark, path)


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside the block go when it ends, not when the driver happens to collect its garbage.

    For writes and looks whose plan is run once: a plan that is run again would have to make its shuffle files again.
    """
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE)
        else:
            spark.conf.set(_FREE, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows as a written table in the shared folder: lineage ends there, columns stay prunable."""
    path = work_path(df.sparkSession, label)
    with freeing(df.sparkSession):
        df.write.option("compression", STORED_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
