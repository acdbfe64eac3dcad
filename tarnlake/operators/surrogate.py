"""Dense surrogate keys without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tarnlake.operators.merge import by_key
from tarnlake.session import staged
from tarnlake.sinks import files as sinks

_ROW_BITS = 33                # layout of monotonically_increasing_id: partition above, row below
_ID, _PART, _ROW, _BEFORE = "__id", "__part", "__row", "__before"


def assign(df: DataFrame, name: str, order: Sequence[str] | None = None, after: DataFrame | None = None) -> DataFrame:
    """Number rows `max(after.name) + 1 ..` densely, in the order of the columns if they are given.

    Without an order rows are numbered as they lie: nothing is sorted or moved. With one they are range-partitioned and
    sorted on the order columns (which must identify a row, so no value of one of them can overload a partition). Either way
    they are written, when this is called, with their place within the partition. The written table fixes those places,
    whatever is recomputed later; a running total of partition sizes turns them into numbers.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(df.withColumn(_ID, F.monotonically_increasing_id()), name).select(
        *df.columns,
        F.shiftright(_ID, _ROW_BITS).alias(_PART),
        F.col(_ID).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(_ROW),
    )
    # one row per partition: the only window that spans them all
    running = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(_PART).agg((F.max(_ROW) + 1).alias("__size"))
    starts = staged(sizes.select(_PART, F.coalesce(F.sum("__size").over(running), F.lit(0)).alias(_BEFORE)), "partition-starts")
    position = F.col(_ROW) + F.col(_BEFORE) + 1
    if after is not None:
        position = position + after.agg(F.coalesce(F.max(name), F.lit(0))).scalar()
    return placed.join(starts, _PART).select(*df.columns, position.cast("long").alias(name))


def assign_missing(df: DataFrame, name: str, order: Sequence[str], after: DataFrame) -> DataFrame:
    """Number the rows that have no number yet, after the largest of `after`, in the order of the columns; the others keep theirs."""
    fresh = assign(df.filter(F.col(name).isNull()).drop(name), name, order, after)
    return df.filter(F.col(name).isNotNull()).unionByName(fresh)


def assign_stable(df: DataFrame, name: str, keys: Sequence[str], path: str, app: str = "keys") -> DataFrame:
    """Number rows by their natural key from a map kept below `path`: a key keeps its number over all loads.

    Keys the map does not hold get the next numbers, in key order, and are appended to it before any row carries them; so a load that
    is repeated, or died half-way, finds the numbers it gave. Rows of equal key share a number; rows without a full key get
    none. The map grows by its new keys alone. One load at a time.
    """
    spark, keys = df.sparkSession, list(keys)
    full, loose = by_key(df, keys)
    wanted = staged(full.select(*keys).distinct(), "natural-keys")
    known = sinks.read_batches(spark, path)
    fresh = wanted if known is None else wanted.join(known.select(*keys), keys, "left_anti")
    fresh = staged(fresh, "fresh-keys")
    if not fresh.isEmpty():
        numbered = assign(fresh, name, keys, None if known is None else known.select(name))
        batches = sinks.finished_batches(spark, path)
        sinks.append_batch(numbered, path, app, 1 + max((b["batch_id"] for b in batches), default=-1))
        known = sinks.read_batches(spark, path)
    held = wanted.select(*keys, F.lit(None).cast("long").alias(name)) if known is None else known.select(*keys, name)
    given = full.join(held, keys).select(*(f"`{c}`" for c in df.columns), name)
    return given.unionByName(loose.withColumn(name, F.lit(None).cast("long")))
