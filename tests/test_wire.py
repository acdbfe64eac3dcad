import base64
from decimal import Decimal
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarnlake.functions import (
    decode_decimal, encode_decimal, epoch_millis, from_epoch_days, from_epoch_micros, path_safe, row_hash,
)


def wire(n, size=None):
    size = size or max(1, (n.bit_length() + 8) // 8)
    return base64.b64encode(n.to_bytes(size, "big", signed=True)).decode()


@pytest.mark.parametrize("text, scale, want", [
    ("CO96", 2, "5855.94"), ("/w==", 2, "-0.01"), ("AIA=", 2, "1.28"), ("gA==", 2, "-1.28"), ("AA==", 2, "0.00"),
    (wire(10**15 - 1), 2, "9999999999999.99"), (wire(-(10**15 - 1)), 2, "-9999999999999.99"),
    (wire(12345, 8), 2, "123.45"), (wire(-12345, 12), 2, "-123.45"),
    (wire(15 * 10**16), 16, "15.00"), (wire(123456), 4, "12.35"), (wire(-123455), 4, "-12.35"), (wire(7), 0, "7.00"),
    (wire(1, 16), 2, "0.01"), (wire(12345, 16), 2, "123.45"), (wire(-12345, 40), 2, "-123.45"), (wire(-1, 17), 0, "-1.00"),
    (wire(1234567), 45, "0.00"), (wire(12), -2, "1200.00"), (wire(-12), -2, "-1200.00"), (wire(0, 20), -5, "0.00"),
    (wire(1234 * 10**28 + 10**28 // 2), 30, "12.35"), (wire(-(1234 * 10**28 + 10**28 // 2), 16), 30, "-12.35"), (wire(123450, 16), 3, "123.45"),
    (wire(7 * 10**60), 60, "7.00"), (wire(-(2**200)), 60, "-1.61"), (wire(2**56), 15, "72.06"), (wire(-(2**63), 8), 17, "-92.23"),
    ("", 2, None), (None, 2, None),
])
def test_decode(spark, text, scale, want):
    df = spark.createDataFrame([(text, scale)], "t string, s int")
    expected = None if want is None else Decimal(want)
    got = df.select(decode_decimal(F.col("t"), F.col("s")), decode_decimal(F.col("t"), scale)).first()
    assert tuple(got) == (expected, expected)


@pytest.mark.parametrize("text, scale", [(wire(10**15), 2), (wire(-(10**40)), 2), (wire(99), -20)])
def test_values_that_do_not_fit_raise(spark, text, scale):
    df = spark.createDataFrame([(text, scale)], "t string, s int")
    with pytest.raises(Exception, match="does not fit"):
        df.select(decode_decimal(F.col("t"), F.col("s"))).collect()


def test_wide_values_round_trip_exactly(spark):
    values = [10**n + d for n in (16, 17, 18, 20, 25, 30, 34, 37) for d in (-1, 0, 1)] + [2**n for n in range(50, 120, 7)]
    values += [-v for v in values]
    df = spark.createDataFrame([(wire(v), str(v)) for v in values], "t string, want string")
    out = df.select(decode_decimal(F.col("t"), 0, "decimal(38,0)").cast("string").alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in out)


def test_encode_is_the_inverse(spark):
    df = spark.createDataFrame([(Decimal(x),) for x in ("0.00", "-0.01", "5855.94", "-99999.99")], "a decimal(15,2)")
    assert df.filter(decode_decimal(encode_decimal(F.col("a")), 2) != F.col("a")).isEmpty()


def test_times_keep_their_fraction(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00.123456", 1704067200123456, 19723)], "t string, us long, d int")
    out = df.select(epoch_millis("t"), from_epoch_micros("us"), from_epoch_days("d")).first()
    assert out[0] == 1704067200123
    assert out[1] == datetime(2024, 1, 1, 0, 0, 0, 123456)
    assert str(out[2]) == "2024-01-01"


def test_hash_tells_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    assert df.select(row_hash(["x", "y"]).alias("h")).distinct().count() == 2


def test_path_safe(spark):
    df = spark.createDataFrame([("manual__2025-01-01T10:20:30+00:00",)], "r string")
    assert df.select(path_safe(F.col("r"))).first()[0] == "manual__2025-01-01T10-20-30Z"


def test_eight_bytes_need_no_wide_arithmetic(spark, monkeypatch):
    """Values that fit a long are decoded without the arithmetic on limbs, which is interpreted row by row."""
    monkeypatch.setattr("tarnlake.functions.wire._wide", lambda digits, negative: F.raise_error(F.lit("wide")).cast("string"))
    values = [0, 1, -1, 127, -128, 25500, -25500, 2**55, -2**55, 10**13, -10**13]
    df = spark.createDataFrame([(wire(n, 8), str(n)) for n in values] + [(wire(n), str(n)) for n in values], "t string, want string")
    out = df.select(decode_decimal(F.col("t"), 0, "decimal(38,0)").cast("string").alias("got"), "want").collect()
    assert [r.got for r in out] == [r.want for r in out]
    ends = spark.createDataFrame([(wire(n, 8), str(n)) for n in (2**63 - 1, -2**63)], "t string, want string")
    assert ends.filter(decode_decimal(F.col("t"), 0, "decimal(38,0)").cast("string") != F.col("want")).isEmpty()
