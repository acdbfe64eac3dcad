"""Change detection over tracked columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash in which a NULL counts: (NULL, 'a') and ('a', NULL) differ."""
    parts: list[Column] = []
    for name in columns:
        parts += [F.col(name).isNull(), F.col(name)]
    return F.xxhash64(*parts)


def differs(left: str, right: str, columns: Sequence[str]) -> Column:
    """True when any tracked column differs between two aliased sides.

    Compares the values themselves: a hash can collide, values cannot.
    """
    tests = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a | b, tests, F.lit(False))
