"""Epoch conversions that keep milliseconds and microseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(c: Column | str) -> Column:
    return _col(c).cast("timestamp_ntz")


def from_epoch_millis(c: Column | str) -> Column:
    return ntz(F.timestamp_millis(_col(c)))


def from_epoch_micros(c: Column | str) -> Column:
    return ntz(F.timestamp_micros(_col(c)))


def from_epoch_days(c: Column | str) -> Column:
    return F.date_from_unix_date(_col(c))


def epoch_millis(c: Column | str) -> Column:
    """Epoch milliseconds of a timestamp or of its text form."""
    return F.unix_millis(_col(c).cast("timestamp"))


def epoch_micros(c: Column | str) -> Column:
    return F.unix_micros(_col(c).cast("timestamp"))
