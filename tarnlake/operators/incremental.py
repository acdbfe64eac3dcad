"""Incremental control and incrementally kept aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarnlake.operators.merge import Delete, Insert, Update, merge_apply, sizeable
from tarnlake.session import remove, staged
from tarnlake.sinks.files import write_partitions

LOOKBACK_DAYS = 3
_PLAIN = " !$&()+,;<>@`|~"       # characters that folder names hold as they are, beside letters, digits and -._


def bounds(feed_bounds: DataFrame, processed: DataFrame, interval_end: Column) -> DataFrame:
    """One row: where the next incremental read starts and ends.

    `start_ts` is the later of the first commit and the last processed commit, `end_ts`
    the earlier of the interval end and the last commit, NULL when it equals the start.
    An empty feed gives `start_version` 0 and no times.
    `processed` holds one row with column `last_processed_ts` (NULL on a first run).
    """
    last = processed.agg(F.max("last_processed_ts")).scalar()
    start = F.greatest("first_commit_ts", last)
    end = F.least(interval_end.cast("timestamp_ntz"), F.col("last_commit_ts"))
    empty = F.col("first_commit_ts").isNull()
    return feed_bounds.select(
        F.when(empty, F.lit(0).cast("long")).alias("start_version"),
        F.when(~empty, start).alias("start_ts"),
        F.when(~empty & (start != end), end).alias("end_ts"),
    )


def lookback_window(df: DataFrame, column: str, start: datetime, end: datetime, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows in `[start - days, end)`: late data is read again rather than missed.

    Bounds are plain literals of the column's own type, so the scan skips row groups.
    """
    kind = df.schema[column].dataType
    low, high = start - timedelta(days=days), end
    if kind.typeName() in ("long", "integer"):  # epoch milliseconds
        low, high = (F.lit(round((t - datetime(1970, 1, 1)).total_seconds() * 1000)) for t in (low, high))
    else:
        low, high = (F.lit(str(t)).cast(kind) for t in (low, high))
    return df.filter((F.col(column) >= low) & (F.col(column) < high))


def since_last(df: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Rows at or after the newest value already in the target (all rows when it is empty).

    That one value is fetched first, so the scan gets a literal to prune files by.
    """
    last = target.agg(F.max(target_column)).first()[0]
    return df if last is None else df.filter(F.col(column) >= F.lit(str(last)).cast(df.schema[column].dataType))


def affected_keys(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct aggregate keys touched by a feed, from pre- and post-images, with the last commit."""
    return feed.groupBy(*keys).agg(F.max("_commit_timestamp").alias("record_commit_timestamp"))


def recompute_affected(
    current: DataFrame,
    base: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    quantity: str,
    total: str = "sold_qty",
    stored: bool = False,
) -> DataFrame:
    """Bring an aggregate up to date by recomputing the keys a feed touched.

    Keys that lost all their rows are removed; keys whose total did not change keep
    their commit time. A feed that is `stored` is looked at first: sums of many keys meet the aggregate in one join.
    """
    keys = list(keys)
    touched = affected_keys(feed, keys)
    sums = (
        base.join(touched.select(*keys), keys, "left_semi")
        .groupBy(*keys)
        .agg(F.sum(quantity).alias(total))
    )
    source = touched.join(sums, keys, "left").withColumn("__gone", F.col(total).isNull())
    return merge_apply(
        current,
        source,
        keys,
        matched=[
            Delete(when=F.col("source.__gone")),
            Update(
                when=~F.col(f"source.{total}").eqNullSafe(F.col(f"target.{total}")),
                set={c: F.col(f"source.{c}") for c in (total, "record_commit_timestamp")},
            ),
        ],
        not_matched=[Insert(
            when=~F.col("source.__gone"),
            values={c: F.col(f"source.{c}") for c in (*keys, total, "record_commit_timestamp")},
        )],
        unique_source=True,
        stage=True,
        together=stored and sizeable(feed, keys),
    )


def overwrite_affected(
    spark: SparkSession,
    path: str,
    base: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    partition: str,
    quantity: str,
    total: str = "sold_qty",
) -> list:
    """Bring a stored aggregate up to date by rewriting only the partitions a feed touches; returns their values.

    The aggregate lies below `path` in a folder per value of `partition`, a column that follows from the keys and that `base` and `feed` have
    too. The touched values are found first (one per folder at most), only these partitions are read, and they alone are overwritten; what
    is left without rows is removed. Of `base` only rows of touched partitions and keys are aggregated. Readers see partitions change one after the other.
    """
    feed = staged(feed.select(*keys, partition, "_commit_timestamp").distinct(), "touched-keys")
    values = [r[0] for r in feed.select(partition).distinct().orderBy(partition).collect()]
    if not values:
        return []
    here = reduce(lambda a, b: a | b, [F.col(partition).eqNullSafe(F.lit(v)) for v in values])
    stored = spark.read.parquet(path)
    current = staged(stored.filter(here), "touched-partitions")
    after = staged(recompute_affected(current, base.filter(here), feed, [*keys, partition], quantity, total, stored=True), "partitions-after")
    write_partitions(after.select(*stored.columns), path, [partition])
    left = {r[0] for r in after.select(partition).distinct().collect()}
    for value in values:
        if value not in left:
            folder = "__HIVE_DEFAULT_PARTITION__" if value is None else quote(str(value), safe=_PLAIN)
            remove(spark, f"{path}/{partition}={folder}")
    return values


def apply_deltas(
    current: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    quantity: str,
    total: str = "sold_qty",
    rows: str = "n_rows",
    stored: bool = False,
) -> DataFrame:
    """Bring an aggregate up to date from the feed alone, without reading the base table.

    Post-images add, pre-images and deletes subtract; the row count tells when a
    key is empty. Work grows with the changes only. Amounts must be decimal or integer,
    so that adding and subtracting is exact. A feed that is `stored` is looked at first: sums
    of many keys meet the aggregate in one join, where they lie already.
    """
    keys = list(keys)
    sign = F.when(F.col("_change_type").isin("insert", "update_postimage"), F.lit(1)).otherwise(F.lit(-1))
    deltas = feed.groupBy(*keys).agg(
        F.sum(F.col(quantity) * sign).alias("__sum"),
        F.sum(sign).alias("__rows"),
        F.max("_commit_timestamp").alias("record_commit_timestamp"),
    )
    new_rows = F.col(f"target.{rows}") + F.col("source.__rows")
    moved = (F.col("source.__sum") != 0) | (F.col("source.__rows") != 0)
    new_total = (F.col(f"target.{total}") + F.col("source.__sum")).cast(current.schema[total].dataType)
    return merge_apply(
        current,
        deltas,
        keys,
        matched=[
            Delete(when=new_rows <= 0),
            Update(
                when=moved,
                set={
                    total: new_total,
                    rows: new_rows,
                    "record_commit_timestamp": F.when(
                        F.col("source.__sum") != 0, F.col("source.record_commit_timestamp")
                    ).otherwise(F.col("target.record_commit_timestamp")),
                },
            ),
        ],
        not_matched=[Insert(
            when=F.col("source.__rows") > 0,
            values={
                **{k: F.col(f"source.{k}") for k in keys},
                total: F.col("source.__sum"),
                rows: F.col("source.__rows"),
                "record_commit_timestamp": F.col("source.record_commit_timestamp"),
            },
        )],
        unique_source=True,
        stage=True,
        together=stored and sizeable(feed, keys),
    )
