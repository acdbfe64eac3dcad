"""Change feed between table snapshots, and its replay."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tarnlake.operators.latest import latest_by
from tarnlake.operators.merge import DELETE, INSERT, KEEP, KIND, POST, PRE

TYPE, VERSION, COMMITTED = "_change_type", "_commit_version", "_commit_timestamp"
POST_IMAGES = ["insert", "update_postimage", "delete"]


def outcome(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What becomes of every row when `new` takes the place of `old`, in column `__kind`, as `merge_outcome` tells it."""
    names = new.columns
    o, n = old.select(*names).withColumn("__in", F.lit(True)).alias("o"), new.withColumn("__in", F.lit(True)).alias("n")
    on = reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(f"o.`{c}`").eqNullSafe(F.col(f"n.`{c}`")) for c in names])

    def row(side: str, kind: str) -> Column:
        return F.struct(*[F.col(f"{side}.`{c}`").alias(c) for c in names], F.lit(kind).alias(KIND))

    rows = (
        F.when(F.col("o.__in").isNull(), F.array(row("n", INSERT)))
        .when(F.col("n.__in").isNull(), F.array(row("o", DELETE)))
        .when(~same, F.array(row("o", PRE), row("n", POST)))
        .otherwise(F.array(row("n", KEEP)))
    )
    return o.join(n, on, "full").select(F.explode(rows).alias("r")).select("r.*")


def diff(
    old: DataFrame, new: DataFrame, keys: Sequence[str], version: int, committed: Column
) -> DataFrame:
    """Change rows that turn `old` into `new`, with pre- and post-images of updates."""
    return outcome(old, new, keys).filter(F.col(KIND) != KEEP).select(
        *new.columns, F.col(KIND).alias(TYPE), F.lit(version).cast("long").alias(VERSION),
        committed.cast("timestamp_ntz").alias(COMMITTED),
    )


def read_range(
    feed: DataFrame,
    from_version: int | None = None,
    to_version: int | None = None,
    from_ts: Column | None = None,
    to_ts: Column | None = None,
) -> DataFrame:
    """Feed rows within inclusive version or commit-time bounds."""
    for test in (
        None if from_version is None else F.col(VERSION) >= from_version,
        None if to_version is None else F.col(VERSION) <= to_version,
        None if from_ts is None else F.col(COMMITTED) >= from_ts,
        None if to_ts is None else F.col(COMMITTED) <= to_ts,
    ):
        feed = feed if test is None else feed.filter(test)
    return feed


def bounds(feed: DataFrame) -> DataFrame:
    """First and last commit time and version of a feed."""
    return feed.agg(
        F.min(COMMITTED).alias("first_commit_ts"),
        F.max(COMMITTED).alias("last_commit_ts"),
        F.min(VERSION).alias("first_version"),
        F.max(VERSION).alias("last_version"),
    )


def post_images(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col(TYPE).isin(POST_IMAGES))


def net_changes(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last change per key, by version and then by kind within one commit."""
    # within one commit a post-image outranks an insert, and an insert a delete
    rank = F.when(F.col(TYPE) == "delete", 1).when(F.col(TYPE) == "insert", 2).otherwise(3)
    ranked = post_images(feed).withColumn("__rank", rank)
    return latest_by(ranked, keys, [VERSION, "__rank"]).drop("__rank")


def replay(old: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The snapshot the feed leads to from `old`."""
    last = net_changes(feed, keys)
    untouched = old.join(last.select(*keys), list(keys), "left_anti").select(*old.columns)
    return untouched.unionByName(last.filter(F.col(TYPE) != "delete").select(*old.columns))
