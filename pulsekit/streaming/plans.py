"""Streaming forms of the window, top-N, distinct and join jobs.

Each function takes streaming frames (``timestamp`` event time) and returns a
streaming frame for append mode; chained stateful steps rely on Spark's
watermark propagation between operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.time import floor_div, to_micros


def _txt(span) -> str:
    return f"{to_micros(span)} microseconds"


def stream_panes(df: DataFrame, ts: str, keys, size, slide=None, name: str = "cnt") -> DataFrame:
    """Counts per key and window ``w`` on a watermarked stream, rows counted once.

    Rows are first counted per pane of the slide's length; a sliding window
    then sums panes, so the copies (size / slide of them) are of panes, not
    of rows.  The slide must divide the size.
    """
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    slide = slide or size
    if to_micros(size) % to_micros(slide):
        raise ValueError("the slide must divide the size")
    panes = df.groupBy(F.window(ts, _txt(slide)).alias("w"), *keys).agg(F.count(F.lit(1)).alias(name))
    if to_micros(size) == to_micros(slide):
        return panes
    return (panes.groupBy(F.window(F.window_time("w"), _txt(size), _txt(slide)).alias("w2"), *keys)
            .agg(F.sum(name).alias(name)).withColumnRenamed("w2", "w"))


def stream_window_counts(df: DataFrame, ts: str, keys, size, slide=None, name: str = "cnt") -> DataFrame:
    """:func:`stream_panes` with the window's two ends as columns."""
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    g = stream_panes(df, ts, keys, size, slide, name)
    return g.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), name)


def stream_distinct_per_window(df: DataFrame, ts: str, id_col: str, size, name: str = "uv") -> DataFrame:
    """A5 on a stream: de-duplicate (window, id) in state, then count per window."""
    w = df.withColumn("w", F.window(ts, _txt(size))).dropDuplicates(["w", id_col])
    g = w.groupBy("w").agg(F.count(F.lit(1)).alias(name))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), name)


def stream_interval_join(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str, lower, upper) -> DataFrame:
    """J1 on streams: both sides watermarked; the time bound lets Spark drop join state.

    State is split by key and time bucket, so a key with a third of all rows
    is spread over its buckets: buckets are as long as the bounds are apart,
    a right row has one, a left row comes to the two (at most) that hold
    its partners, and each pair meets once.
    """
    low, high = to_micros(lower), to_micros(upper)
    size = max(high - low, 1)
    at = F.unix_micros(left_ts)
    buckets = F.array_distinct(F.array(floor_div(at + F.lit(low), size), floor_div(at + F.lit(high), size)))
    a = left.withColumn("_bucket", F.explode(buckets))
    b = right.withColumnRenamed(on, "_rk").withColumn("_rb", floor_div(F.unix_micros(right_ts), size))
    cond = F.expr(f"{on} = _rk AND _bucket = _rb AND {right_ts} >= {left_ts} + INTERVAL '{low / 1e6:.6f}' SECOND "
                  f"AND {right_ts} <= {left_ts} + INTERVAL '{high / 1e6:.6f}' SECOND")
    return a.join(b, cond).drop("_rk", "_bucket", "_rb")


def stream_reconcile(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str, left_id: str, right_id: str, lower, upper,
                     left_only="pay_only", right_only="receipt_only") -> DataFrame:
    """J2 on streams: the pairs of :func:`stream_interval_join` and the rows of either side that have none.

    A row is left over once the watermark is past its last possible partner
    and no pair had it.  That is kept by bucket of row ids (whole numbers,
    unique within a side), so no key gathers rows.  Times are epoch microseconds:
    on, left_us, left_id, right_us, right_id, status.
    """
    from pulsekit.streaming.processors import leftovers
    low, high = to_micros(lower), to_micros(upper)
    # not through the watermarked columns: rows and pairs behind the watermark must reach the processor
    us = {c: F.unix_micros(c) for c in (left_ts, right_ts)}
    pairs = stream_interval_join(left, right, on, left_ts, right_ts, lower, upper).select(
        F.col(on).alias("key"), us[left_ts].alias("left_us"), F.col(left_id).cast("long").alias("left_id"),
        us[right_ts].alias("right_us"), F.col(right_id).cast("long").alias("right_id"))
    none = F.lit(None).cast("long")

    def alone(df, ts, row_id, is_left):
        return df.select(F.lit(is_left).alias("side"), F.col(row_id).cast("long").alias("id"), F.col(on).alias("key"), us[ts].alias("us"),
                         F.lit(False).alias("paired"), none.alias("other_us"), none.alias("other_id"))

    def told(is_left, mine, other):
        return F.struct(F.lit(is_left).alias("side"), F.col(f"{mine}_id").alias("id"), "key", F.col(f"{mine}_us").alias("us"),
                        F.lit(True).alias("paired"), F.col(f"{other}_us").alias("other_us"), F.col(f"{other}_id").alias("other_id"))

    rows = alone(left, left_ts, left_id, True).unionByName(alone(right, right_ts, right_id, False))
    both = pairs.select(F.inline(F.array(told(True, "left", "right"), told(False, "right", "left"))))
    return leftovers(rows.unionByName(both), {True: (high, left_only), False: (-low, right_only)}).withColumnRenamed("key", on)
