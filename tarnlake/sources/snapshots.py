"""Tables kept as versioned parquet snapshots, with the change rows of each version beside it.

Each write goes to a directory of its own and then adds one line to the commit
list; a reader takes the newest committed directory. A write that dies half-way
leaves no commit, so it is never read, and a table is never overwritten while it
is being read.

Within a version rows lie in a folder per kind: kept, inserted, updated (before and after), deleted. A table reads the folders of its
rows, a change feed those of what changed, so nothing is stored twice, and reading changes compares nothing.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructType
from pyspark.sql.utils import AnalysisException

from tarnlake.operators import changefeed
from tarnlake.operators.merge import DELETE, INSERT, KEEP, KIND, POST, PRE, Delete, Insert, Update, merge_outcome
from tarnlake.session import freeing

_VERSION = "__version"
_PUBLIC = ["version", "committed_at", "operation", "num_rows", "note"]
_COMMIT = "version long, committed_at timestamp_ntz, operation string, num_rows long, note string, feed boolean, columns string"
_ROWS, _CHANGED = [KEEP, POST, INSERT], [INSERT, PRE, POST, DELETE]


def _commits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_COMMIT).json(f"{path}/_commits", pathGlobFilter="*.json")


def history(spark: SparkSession, path: str) -> DataFrame:
    """Commits of a table, one row each."""
    return _commits(spark, path).select(*_PUBLIC)


def last(spark: SparkSession, path: str) -> Row | None:
    """The newest commit (version, time, operation, rows, note, ...), or None."""
    try:
        return _commits(spark, path).orderBy(F.desc("version")).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def exists(spark: SparkSession, path: str) -> bool:
    return last(spark, path) is not None


def write(
    df: DataFrame, path: str, operation: str, committed_at: datetime, note: str = "", keys: Sequence[str] | None = None
) -> int:
    """Write a new version and commit it; returns its number. One writer per table at a time.

    The first version is all inserts. A later one that replaces the table gets change rows if `keys` tells which rows
    belong together: old and new rows are then compared, once, while they are written. Without keys that version has none.
    """
    newest = last(df.sparkSession, path)
    if newest is None:
        rows, feed = df.withColumn(KIND, F.lit(INSERT)), True
    elif keys:
        rows, feed = changefeed.outcome(read(df.sparkSession, path, newest["version"]), df, keys), True
    else:
        rows, feed = df.withColumn(KIND, F.lit(KEEP)), False
    return _commit(rows, path, 0 if newest is None else newest["version"] + 1, operation, committed_at, note, feed)


def merge(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    on: Sequence[str],
    operation: str,
    committed_at: datetime,
    matched: Sequence[Update | Delete] = (),
    not_matched: Sequence[Insert] = (),
    note: str = "",
    unique_source: bool = False,
) -> int:
    """Merge `source` into the newest version and commit the outcome: the new version and its change rows in one write."""
    newest = last(spark, path)
    target = read(spark, path, newest["version"])
    rows = merge_outcome(target, source, on, matched, not_matched, unique_source, stage=True)
    return _commit(rows, path, newest["version"] + 1, operation, committed_at, note, True)


def _commit(rows: DataFrame, path: str, version: int, operation: str, committed_at: datetime, note: str, feed: bool) -> int:
    spark, schema = rows.sparkSession, rows.drop(KIND).schema
    with freeing(spark):
        rows.write.mode("overwrite").partitionBy(KIND).parquet(f"{path}/{_VERSION}={version}")
    written = _scan(spark, path, [version], schema).filter(F.col(KIND).isin(_ROWS))
    commit = written.agg(F.count(F.lit(1)).alias("num_rows")).select(
        F.lit(version).cast("long").alias("version"),
        F.lit(str(committed_at)).cast("timestamp_ntz").alias("committed_at"),
        F.lit(operation).alias("operation"),
        "num_rows",
        F.lit(note).alias("note"),
        F.lit(feed).alias("feed"),
        F.lit(schema.json()).alias("columns"),
    )
    commit.coalesce(1).write.mode("append").json(f"{path}/_commits")
    return version


def _scan(spark: SparkSession, path: str, versions: Sequence[int], schema: StructType) -> DataFrame:
    """All rows of the versions' folders with their version and kind, which come from the folders' names."""
    full = StructType([*schema.fields]).add(_VERSION, LongType()).add(KIND, StringType())
    return spark.read.schema(full).option("basePath", path).parquet(*(f"{path}/{_VERSION}={v}" for v in versions))


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the table, the newest by default."""
    commit = last(spark, path) if version is None else _commits(spark, path).filter(F.col("version") == version).first()
    schema = StructType.fromJson(json.loads(commit["columns"]))
    return _scan(spark, path, [commit["version"]], schema).filter(F.col(KIND).isin(_ROWS)).select(*(f"`{c}`" for c in schema.names))


def feed_bounds(spark: SparkSession, path: str) -> DataFrame:
    """First and last commit time and version of a table's change feed, from the commit list alone."""
    return changefeed.bounds(_commits(spark, path).select(
        F.col("version").alias(changefeed.VERSION), F.col("committed_at").alias(changefeed.COMMITTED)))


def versions_between(
    spark: SparkSession, path: str, from_ts: datetime | None = None, to_ts: datetime | None = None, after: int = -1
) -> list[int]:
    """Numbers of the versions above `after` committed within inclusive times, from the commit list alone."""
    found = _commits(spark, path).filter(F.col("version") > after)
    for test in (None if from_ts is None else F.col("committed_at") >= F.lit(str(from_ts)).cast("timestamp_ntz"),
                 None if to_ts is None else F.col("committed_at") <= F.lit(str(to_ts)).cast("timestamp_ntz")):
        found = found if test is None else found.filter(test)
    return sorted(r["version"] for r in found.select("version").collect())      # a number per version asked for


def changes(spark: SparkSession, path: str, from_version: int = 0, to_version: int | None = None) -> DataFrame:
    """Change feed of a table: what its versions from `from_version` to `to_version` (the newest) changed.

    Rows carry pre- and post-images, the version and its commit time; they are those the writers left, so only the change rows of
    these versions are read. Columns are those of the newest of them. A version replaced without keys has no change rows: asking for
    it raises.
    """
    asked = _commits(spark, path).filter(F.col("version") >= from_version)
    asked = asked if to_version is None else asked.filter(F.col("version") <= to_version)
    commits = asked.orderBy("version").collect()                 # one row per version asked for
    if not commits:
        schema = read(spark, path).schema
        return spark.createDataFrame([], schema).withColumns({
            changefeed.TYPE: F.lit(""), changefeed.VERSION: F.lit(0).cast("long"), changefeed.COMMITTED: F.lit(None).cast("timestamp_ntz")})
    without = [c["version"] for c in commits if not c["feed"]]
    if without:
        raise ValueError(f"no change rows were kept for version {without[0]} of {path}: it was replaced without keys")
    schema = StructType.fromJson(json.loads(commits[-1]["columns"]))
    times = F.create_map(*(x for c in commits for x in (F.lit(c["version"]), F.lit(str(c["committed_at"])))))
    rows = _scan(spark, path, [c["version"] for c in commits], schema).filter(F.col(KIND).isin(_CHANGED))
    return rows.select(
        *(f"`{c}`" for c in schema.names), F.col(KIND).alias(changefeed.TYPE), F.col(_VERSION).alias(changefeed.VERSION),
        times[F.col(_VERSION)].cast("timestamp_ntz").alias(changefeed.COMMITTED))
