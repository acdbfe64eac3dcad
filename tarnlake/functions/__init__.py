"""Column functions: money, time, hashing and wire-format decoding."""

from tarnlake.functions.hashing import differs, row_hash
from tarnlake.functions.money import average, exact_sum, exact_total, hundredths, money
from tarnlake.functions.time import (
    epoch_micros,
    epoch_millis,
    from_epoch_days,
    from_epoch_micros,
    from_epoch_millis,
    ntz,
)
from tarnlake.functions.wire import decode_decimal, encode_decimal, path_safe

__all__ = [
    "average", "decode_decimal", "differs", "encode_decimal", "epoch_micros", "epoch_millis", "exact_sum",
    "exact_total", "from_epoch_days", "from_epoch_micros", "from_epoch_millis", "hundredths", "money", "ntz",
    "path_safe", "row_hash",
]
