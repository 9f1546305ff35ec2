"""Pattern rules over per-key event sequences.

Order inside a key is (event time, seq); rows at the same instant keep
arrival order.  ``within`` is strict by default: a match spanning exactly the
``within`` length is a timeout, as in the reference's pattern library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions.time import to_micros
from pulsekit.operators.blocks import time_blocks


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def consecutive(df: DataFrame, key, ts: str, seq: str, cond: Column, n: int, within,
                inclusive: bool = False, block=None) -> DataFrame:
    """``n`` strictly consecutive rows of a key all matching ``cond``, spanning < ``within``.

    Overlapping matches are all reported (a run of ``n + 1`` gives two).
    Returns ``key, first_ts, last_ts, first_seq, last_seq, n_events``.
    """
    keys = _keys(key)
    span = to_micros(within)
    b = time_blocks(df.select(*keys, ts, seq, cond.cast("int").alias("_m")), ts, ahead_us=span, block=block)
    w = Window.partitionBy(*keys, "_blk").orderBy(ts, seq)
    hits = F.sum("_m").over(w.rowsBetween(0, n - 1))
    last_us = F.lead("_us", n - 1).over(w)
    x = b.select(*keys, "_own", "_us", F.col(ts).alias("first_ts"), F.col(seq).alias("first_seq"),
                 hits.alias("_hits"), last_us.alias("_last_us"),
                 F.lead(ts, n - 1).over(w).alias("last_ts"), F.lead(seq, n - 1).over(w).alias("last_seq"))
    gap = F.col("_last_us") - F.col("_us")
    ok = (gap <= span) if inclusive else (gap < span)
    return (x.filter(F.col("_own") & (F.col("_hits") == n) & ok)
            .select(*keys, "first_ts", "last_ts", "first_seq", "last_seq", F.lit(n).cast("int").alias("n_events")))


def followed_by_tagged(df: DataFrame, key, ts: str, seq: str, first: Column, then: Column, within,
                       inclusive: bool = False, block=None) -> DataFrame:
    """N3/N4 in one pass: each ``first`` row with the next ``then`` row of its key (other rows skipped).

    ``status`` is ``match`` where ``then.ts - first.ts < within`` (``<=``
    with ``inclusive``), else ``timeout``, the reference's side output, with
    null ``then`` columns.  Several ``first`` rows may pair with the same
    ``then`` row (no skip strategy).
    """
    keys = _keys(key)
    span = to_micros(within)
    b = time_blocks(df.select(*keys, ts, seq, first.alias("_a"), then.alias("_b")), ts, ahead_us=span, block=block)
    # nearest following ``then`` row: a running ``last`` in descending order is incremental.
    wd = (Window.partitionBy(*keys, "_blk").orderBy(F.col(ts).desc(), F.col(seq).desc())
          .rowsBetween(Window.unboundedPreceding, -1))
    nxt = F.last(F.when(F.col("_b"), F.struct(F.col("_us").alias("us"), F.col(ts).alias("ts"),
                                               F.col(seq).alias("seq"))), ignorenulls=True).over(wd)
    x = (b.filter(F.col("_a") | F.col("_b"))
         .select(*keys, "_own", "_a", "_us", ts, seq, nxt.alias("_n"))
         .filter(F.col("_own") & F.col("_a")))
    gap = F.col("_n.us") - F.col("_us")
    hit = F.col("_n").isNotNull() & ((gap <= span) if inclusive else (gap < span))
    x = x.withColumn("_hit", hit)
    return x.select(*keys, F.col(ts).alias("first_ts"), F.col(seq).alias("first_seq"),
                    F.when(F.col("_hit"), F.col("_n.ts")).alias("then_ts"), F.when(F.col("_hit"), F.col("_n.seq")).alias("then_seq"),
                    F.when(F.col("_hit"), "match").otherwise("timeout").alias("status"))


def followed_by(df: DataFrame, key, ts: str, seq: str, first: Column, then: Column, within,
                inclusive: bool = False, block=None) -> tuple[DataFrame, DataFrame]:
    """``(matches, timeouts)`` of :func:`followed_by_tagged`, for callers that need one of them; both together are two passes."""
    tagged = followed_by_tagged(df, key, ts, seq, first, then, within, inclusive, block)
    return tagged.filter("status = 'match'").drop("status"), tagged.filter("status = 'timeout'").drop("then_ts", "then_seq", "status")
