"""A table of bitmaps that are merged, not recounted.

Ids are hashed to an offset (:func:`bitmap_offset`); the bits of a pane are
kept in buckets of 32,768, one row of 4 KB each: (pane, bucket, bits).  Rows
of one pane and bucket may be appended at any time, also twice: bits are or-ed,
so a replay changes nothing.  Counts of any window of whole panes come from
the table alone.

A window of m panes is the union of two runs of 2^k panes (2^k <= m), which
may overlap as or-ing twice does no harm; runs double from single panes.
That is 2 copies of a row a doubling, where copying each pane into its
windows would be m.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.hashing import BITMAP_CAPACITY, bitmap_offset
from pulsekit.functions.time import floor_div, micros, micros_to, to_micros


def bitmap_partials(df: DataFrame, ts: str, id_col: str, pane="1 hour", capacity: int = BITMAP_CAPACITY) -> DataFrame:
    """pane (number since the epoch), bucket and bits of the ids seen; partial bitmaps are or-ed before the shuffle.

    Rows without a time or an id are left out.
    """
    x = df.select(floor_div(micros(df, ts), to_micros(pane)).alias("pane"), bitmap_offset(F.col(id_col).cast("string"), capacity).alias("off"))
    return (x.filter("pane IS NOT NULL AND off IS NOT NULL")
            .groupBy("pane", F.bitmap_bucket_number("off").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("off")).alias("bits")))


def merged(*tables: DataFrame) -> DataFrame:
    """One row per pane and bucket of all the tables."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    return rows.groupBy("pane", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _either(rows: DataFrame, shift: int) -> DataFrame:
    """Runs that begin at a pane or ``shift`` panes later, or-ed at the earlier place."""
    places = F.array(F.col("pane"), F.col("pane") - F.lit(shift)) if shift else F.array("pane")
    return rows.select(F.explode(places).alias("pane"), "bucket", "bits").groupBy("pane", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_window_counts(table: DataFrame, pane="1 hour", panes: int = 1, name: str = "uv", like=None) -> DataFrame:
    """window_start, window_end and the distinct offsets of every window of ``panes`` panes that holds any.

    ``like``: the type of the bounds (default timestamp_ntz).
    """
    from pyspark.sql import types as T
    if panes < 1:
        raise ValueError("a window has at least one pane")
    rows, have = merged(table), 1
    while have * 2 <= panes:
        rows, have = _either(rows, have), have * 2
    if have < panes:
        rows = _either(rows, panes - have)
    us, kind = to_micros(pane), like or T.TimestampNTZType()
    counts = rows.groupBy("pane").agg(F.sum(F.bitmap_count("bits")).cast("long").alias(name))
    return counts.select(micros_to(F.col("pane") * F.lit(us), kind).alias("window_start"),
                         micros_to((F.col("pane") + panes) * F.lit(us), kind).alias("window_end"), name)
