"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "__rank"


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First whole row of every key under a total order.

    `row_number() = 1` lets Spark cut each map task down to one row per key
    before the shuffle, so a key holding a third of the table costs one row per
    task on the wire, and rows stay flat (no struct-typed aggregation buffer).
    """
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def latest_by(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Newest row per key; `sequence` lists the order columns, tie-breakers last."""
    return first_by(df, keys, [F.col(c).desc_nulls_last() for c in sequence])


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Deterministic survivor per key: smallest row under `order`."""
    return first_by(df, keys, [F.col(c).asc_nulls_last() for c in order])
