"""Rolling string hash used by the bitmap distinct count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference's bitmap: per character ``r = r * 31 + r + c``
# (that is ``32 * r + c``), offset = r & (capacity - 1), capacity = 2^30.
HASH_MULTIPLIER = 32
BITMAP_CAPACITY = 1 << 30


def bitmap_offset(c, capacity: int = BITMAP_CAPACITY) -> Column:
    """Offset of a string id in a ``capacity``-bit bitmap.

    The mask is applied after every character: arithmetic modulo a power of
    two gives the same value as masking once at the end, and it keeps the
    bigint from overflowing (ANSI mode raises on overflow).  Since
    32^6 = 2^30, only the last six characters decide the offset.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    s = F.col(c) if isinstance(c, str) else c
    mask = F.lit(capacity - 1).cast("long")
    chars = F.split(s, "")
    return F.aggregate(
        chars, F.lit(0).cast("long"),
        lambda acc, ch: (acc * HASH_MULTIPLIER + F.ascii(ch).cast("long")).bitwiseAND(mask),
    )
