"""Split per-key sequences into time blocks so a hot key spreads over tasks.

The sequence rules (pairs, consecutive runs, followed-by, order status) look
at most a bounded time back and/or ahead of each row.  Each row is assigned a
home block of ``block`` length and copied into the neighbouring block(s)
whose rows can reach it.  A window function partitioned by
``(keys, _blk)`` and ordered by time then sees, for every row it owns
(``_own``), exactly the neighbours within reach, in the true order: the rows
of a partition are all the key's rows of one contiguous time range.  A
neighbour beyond the range is also beyond reach, so ``lag``/``lead`` return
NULL exactly where the rule would find nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.time import floor_div, micros, to_micros


def default_block(reach_us: int) -> int:
    """Blocks of 8 reaches: an eighth of the rows is copied for each side that a rule looks to."""
    return 8 * reach_us


def time_blocks(df: DataFrame, ts: str, back_us: int = 0, ahead_us: int = 0, block=None) -> DataFrame:
    """Add ``_us`` (epoch µs), ``_blk`` and ``_own`` columns; rows near a block edge are copied.

    ``back_us`` / ``ahead_us``: how far (µs) a rule looks before / after a row.
    ``block``: block length (interval text or seconds); by default 8 reaches.
    """
    bk, ah = int(back_us), int(ahead_us)
    size = to_micros(block) if block else default_block(max(bk, ah, 1))
    if size < max(bk, ah):
        raise ValueError("a block must be at least as long as the reach")
    us = micros(df, ts)
    out = (df.withColumn("_us", us)
           .withColumn("_blk", F.explode(F.sequence(floor_div(F.col("_us") - F.lit(ah), size),
                                                    floor_div(F.col("_us") + F.lit(bk), size)))))
    return out.withColumn("_own", F.col("_blk") == floor_div(F.col("_us"), size))
