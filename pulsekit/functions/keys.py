"""Deterministic salts (P6); a count without a key needs no constant one (P5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def salt(cols, buckets: int = 8, prefix: str | None = None) -> Column:
    """Deterministic salt in ``[0, buckets)`` from a hash of ``cols``.

    The reference draws ``Random.nextInt(8)``; a hash of the row's own columns
    spreads rows the same way and gives the same bucket when a lost task is
    recomputed.  With ``prefix`` the salt is rendered as ``prefix || n``.
    """
    cols = [cols] if isinstance(cols, (str, Column)) else list(cols)
    n = F.pmod(F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols]), F.lit(buckets))
    return F.concat(F.lit(prefix), n.cast("string")) if prefix is not None else n.cast("int")
