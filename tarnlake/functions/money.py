"""Money arithmetic.

Amounts and rates arrive as doubles holding two decimals. They are turned into whole
hundredths, multiplied as integers and summed exactly, so a result depends
neither on how rows are spread over tasks nor on the order partial sums are merged -
and the hot loop stays in primitive types instead of big decimals.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

_LOW_BITS = 20


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hundredths(c: Column | str) -> Column:
    """Whole hundredths of an amount or rate."""
    return F.rint(_col(c).cast("double") * 100).cast("long")


def money(c: Column | str) -> Column:
    return _col(c).cast("decimal(15,2)")


def exact_total(units: Column, scale: int) -> Column:
    """Sum of integers that count units of 10^-scale, as a decimal.

    High and low bits are summed apart, so the sums stay longs while their total may
    exceed one: room for 10^12 rows of 10^13 units (an overflow raises).
    """
    high = F.sum(F.shiftright(units, _LOW_BITS)).cast("decimal(25,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1).cast("long"))).cast("decimal(19,0)")
    whole = (high * F.lit(1 << _LOW_BITS) + low).cast("decimal(38,0)")
    return whole * F.lit(Decimal(1).scaleb(-scale)) if scale else whole


def exact_sum(units: Column, scale: int = 2) -> Column:
    return exact_total(units, scale).cast("double")


def average(units: Column, scale: int = 2) -> Column:
    """Exact sum over the count of non-null values."""
    return exact_sum(units, scale) / F.count(units)
