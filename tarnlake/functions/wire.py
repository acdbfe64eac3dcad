"""Decoding of change-event wire formats, as native expressions (no Python worker)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_LONG_HEX = 16                # up to 8 bytes are one long
_LONG_SCALE = 18              # fraction digits up to which a long is divided exactly
_CHUNK_HEX = 7                # hex digits taken at a time from wider values: 28 bits
_LIMB = 1_000_000_000         # decimal limb of wider values
_FRACTION = 38                # fraction digits kept: no decimal type holds more


def _wide(digits: Column, negative: Column) -> Column:
    """Decimal digits of the magnitude of a two's-complement number of any width.

    Chunks of 28 bits are taken up from the left: the limbs so far are multiplied by 2^28 and the chunk is the carry into
    the lowest. A negative number is inverted, and one is added with its last chunk.
    """
    flipped = F.when(negative, F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210")).otherwise(digits)
    width = F.ceil(F.length(digits) / _CHUNK_HEX) * _CHUNK_HEX
    padded = F.lpad(flipped, width.cast("int"), "0")
    count = (width / _CHUNK_HEX).cast("int")

    def chunk(i: Column) -> Column:
        value = F.conv(F.substring(padded, (i - 1) * _CHUNK_HEX + 1, F.lit(_CHUNK_HEX)), 16, 10).cast("long")
        return value + F.when(negative & (i == count), 1).otherwise(0)

    def take_up(limbs: Column, value: Column) -> Column:
        def step(state: Column, limb: Column) -> Column:
            total = limb * F.lit(1 << 28) + state["carry"]
            return F.struct(F.concat(state["limbs"], F.array((total % _LIMB).cast("long"))).alias("limbs"),
                            F.call_function("div", total, F.lit(_LIMB)).cast("long").alias("carry"))

        start = F.struct(F.array().cast("array<bigint>").alias("limbs"), value.alias("carry"))
        return F.aggregate(limbs, start, step, lambda s: F.concat(s["limbs"], F.array(s["carry"])))

    limbs = F.aggregate(F.transform(F.sequence(F.lit(1), count), chunk), F.array(F.lit(0).cast("long")), take_up)
    return F.array_join(F.transform(F.reverse(limbs), lambda limb: F.lpad(limb.cast("string"), 9, "0")), "")


def decode_decimal(encoded: Column, scale: Column | int, target: str = "decimal(15,2)") -> Column:
    """Base64 of a big-endian two's-complement unscaled integer -> decimal.

    The integer may have any width and the scale any value, negative ones included, and may differ from row to
    row; the target type is fixed, digits beyond it are rounded half up. NULL and empty values give NULL, one that does not fit
    the target raises.
    """
    digits = F.hex(F.unbase64(encoded))
    size = F.length(digits)
    negative = F.substring(digits, 1, 1) >= "8"
    scale = (F.lit(scale) if isinstance(scale, int) else scale).cast("int")
    # filled up with its sign to the 8 bytes of a long, which base -10 reads as signed
    signed = F.conv(F.lpad(digits, F.lit(_LONG_HEX), F.when(negative, F.lit("F")).otherwise(F.lit("0"))), 16, -10)
    short = signed.cast("decimal(20,0)") / F.pow(F.lit(10.0), scale).cast("decimal(20,0)")
    # bound by a one-element array, so that the long arithmetic is in the expression once
    wide = F.element_at(F.transform(F.array(_wide(digits, negative)), lambda whole: _point(whole, negative, scale)), 1)
    plain = (size <= _LONG_HEX) & scale.between(0, _LONG_SCALE)
    number = F.when(plain, short.try_cast(target)).otherwise(wide.try_cast(target))
    misfit = F.raise_error(F.concat(F.lit(f"value does not fit {target}: "), encoded)).cast(target)
    return F.when((size > 0) & scale.isNotNull(), F.coalesce(number, misfit))


def _point(magnitude: Column, negative: Column, scale: Column) -> Column:
    """Decimal number as text from the digits of its magnitude."""
    whole = F.ltrim(magnitude, F.lit("0"))
    shifted = F.concat(whole, F.when((F.length(whole) > 0) & (scale < 0), F.repeat(F.lit("0"), -scale)).otherwise(""))
    places = F.greatest(scale, F.lit(0))
    text = F.lpad(shifted, F.greatest(F.length(shifted), places + 1), "0")
    cut = F.length(text) - places
    return F.concat(
        F.when(negative, F.lit("-")).otherwise(F.lit("")), F.substring(text, F.lit(1), cut), F.lit("."),
        F.substring(text, cut + 1, F.least(places, F.lit(_FRACTION))))


def encode_decimal(amount: Column, scale: int = 2) -> Column:
    """Inverse of `decode_decimal` for amounts that fit 8 bytes (used to build events)."""
    unscaled = F.round(amount.cast(f"decimal(18,{scale})") * F.lit(10 ** scale)).cast("long")
    return F.base64(F.unhex(F.lpad(F.hex(unscaled), 16, "0")))


def path_safe(run_id: Column) -> Column:
    """Run id usable as a directory name: no colons, `Z` for the zero offset."""
    return F.regexp_replace(F.regexp_replace(run_id, r"\+00:00", "Z"), ":", "-")
