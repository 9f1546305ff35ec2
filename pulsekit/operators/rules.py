"""Keyed state rules re-expressed over ordered rows.

Each function gives the answer the reference's keyed process function gives
when every timer and comparison follows event time exactly (one answer, no
dependence on when watermarks happened to be emitted).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions.time import local_day, micros, to_micros
from pulsekit.operators.blocks import time_blocks
from pulsekit.session import checkpoint_dir

# Fixed value: text of the click-cap warning row.
BLACKLIST_WARNING = "blacklisted: daily click cap reached"


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def cap_tagged(df: DataFrame, keys, ts: str, seq: str, max_clicks: int = 100,
               zone: str = "Asia/Shanghai", day: str = "day") -> DataFrame:
    """T1/O1 in one pass: rows with ``status`` ``pass`` or ``warn``; the rest are dropped.

    The n-th click of a (keys, local day) passes when ``n == 1 or n <
    max_clicks`` (the first click always passes, as in the reference); the
    warning is the ``max(2, max_clicks)``-th click.  The day is the calendar
    day in ``zone`` (the reference resets at local midnight, UTC+8).  The
    filter on ``row_number`` lets Spark limit each group on the map side
    before the shuffle: a (user, ad, day) with a third of all clicks ships
    only the few rows that can pass or warn.
    """
    keys = _keys(keys)
    last_pass, warn_at = max(1, max_clicks - 1), max(2, max_clicks)
    w = Window.partitionBy(*keys, day).orderBy(ts, seq)
    n = F.col("_n")
    return (df.withColumn(day, local_day(ts, zone)).withColumn("_n", F.row_number().over(w)).filter(n <= warn_at)
            .withColumn("status", F.when(n <= last_pass, "pass").when(n == warn_at, "warn")).filter("status IS NOT NULL").drop("_n"))


def cap_per_day(df: DataFrame, keys, ts: str, seq: str, max_clicks: int = 100,
                zone: str = "Asia/Shanghai", day: str = "day") -> tuple[DataFrame, DataFrame]:
    """``(passed, warnings)`` of :func:`cap_tagged`, for callers that need one of them; both together are two passes."""
    keys = _keys(keys)
    tagged = cap_tagged(df, keys, ts, seq, max_clicks, zone, day)
    warnings = tagged.filter("status = 'warn'").select(*keys, day, ts, seq, F.lit(BLACKLIST_WARNING).alias("warning"))
    return tagged.filter("status = 'pass'").drop("status"), warnings


def fail_pairs(df: DataFrame, key, ts: str, seq: str, is_fail: Column, interval="2 seconds",
               order: str = "event", block=None, seq_block: int = 1 << 20) -> DataFrame:
    """A fail whose previous row of the key is a fail at most ``interval`` away.

    ``order='event'`` sorts by (time, seq); ``order='arrival'`` follows ``seq``
    only and compares ``abs`` of the time difference, like the reference; a
    key's rows are split into ranges of ``seq_block`` numbers, and the first
    row of a range looks at the last row of the range before it.
    Returns ``key, first_ts, last_ts, first_seq, last_seq``.
    """
    keys = _keys(key)
    span = to_micros(interval)
    base = df.select(*keys, ts, seq, is_fail.alias("_f"))
    if order == "arrival":
        return _arrival_pairs(base, keys, ts, seq, span, seq_block)
    if order != "event":
        raise ValueError("order is 'event' or 'arrival'")
    b = time_blocks(base, ts, back_us=span, block=block)
    w = Window.partitionBy(*keys, "_blk").orderBy(ts, seq)
    x = b.select(*keys, ts, seq, "_f", "_us", "_own",
                 F.lag("_f").over(w).alias("_pf"), F.lag("_us").over(w).alias("_pus"),
                 F.lag(ts).over(w).alias("first_ts"), F.lag(seq).over(w).alias("first_seq"))
    hit = F.col("_own") & F.col("_f") & F.col("_pf") & (F.abs(F.col("_us") - F.col("_pus")) <= span)
    return x.filter(hit).select(*keys, "first_ts", F.col(ts).alias("last_ts"), "first_seq",
                                F.col(seq).alias("last_seq"))


def _arrival_pairs(base: DataFrame, keys: list[str], ts: str, seq: str, span: int, seq_block: int) -> DataFrame:
    row = F.struct(F.col(seq).alias("seq"), F.col("_f").alias("f"), F.col("_us").alias("us"), F.col(ts).alias("ts"))
    x = base.withColumn("_us", micros(base, ts)).withColumn("_blk", F.floor(F.col(seq) / seq_block)).withColumn("_row", row)
    ends = x.groupBy(*keys, "_blk").agg(F.max("_row").alias("_last"))  # a row per key and range
    carry = ends.select(*keys, "_blk", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_blk")).alias("_carry"))
    inside = F.lag("_row").over(Window.partitionBy(*keys, "_blk").orderBy(seq))
    y = x.withColumn("_in", inside).join(carry, keys + ["_blk"]).withColumn("_p", F.coalesce("_in", "_carry"))
    hit = F.col("_f") & F.col("_p.f") & (F.abs(F.col("_us") - F.col("_p.us")) <= span)
    return y.filter(hit).select(*keys, F.col("_p.ts").alias("first_ts"), F.col(ts).alias("last_ts"),
                                F.col("_p.seq").alias("first_seq"), F.col(seq).alias("last_seq"))


def fail_episodes(df: DataFrame, key, ts: str, seq: str, is_fail: Column, interval="2 seconds",
                  grace="0 seconds", block=None) -> DataFrame:
    """The first fail opens an episode closing ``interval`` later; >= 2 fails → one alert.

    A success before the close cancels the episode; the next fail after the
    close opens a new one.  ``grace`` widens the close the way the
    reference's watermark delay does (it counts fails arriving up to that
    much later).  Returns ``key, first_ts, last_ts, n_fails``.

    The episodes of a run of fails depend on each other: each starts at the
    first fail after the one before it closed.  That chain is not walked.
    Every fail gets the episode that it would open and the fail that would
    open the next one, from running counts per (key, time block) at the time
    its episode would close; a fail after a success, or after a gap beyond
    reach, opens one whatever came before; and the fails that these lead to
    are found by doubling the links (:func:`_reached`).  A task holds the
    rows of one block, however long a run of fails is.
    """
    keys = _keys(key)
    checkpoint_dir(df.sparkSession)
    reach = to_micros(interval) + to_micros(grace)
    base = df.select(*keys, ts, seq, is_fail.alias("_f"))
    # A next opener beyond two reaches follows a gap beyond reach, so it opens an episode anyway.
    if block:
        block = f"{max(to_micros(block), 2 * reach)} us"
    b = time_blocks(base, ts, back_us=reach, ahead_us=2 * reach, block=block)
    part = Window.partitionBy(*keys, "_blk")
    w, one = part.orderBy("_us", seq), F.lit(1).cast("long")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    x = b.withColumn("_n", F.sum(F.when(F.col("_f"), one).otherwise(0)).over(upto)).withColumn("_ok", F.sum(F.when(F.col("_f"), 0).otherwise(one)).over(upto))
    after_ok = F.lag("_f").over(w)
    x = x.withColumn("_opens", F.col("_f") & (after_ok.isNull() | ~after_ok | (F.col("_us") - F.lag("_us").over(w) > reach)))
    # each own fail once more, at the time its episode would close, after all rows of that time
    close = F.struct((F.col("_us") + F.lit(reach)).alias("t"), F.lit(True).alias("closes"))
    x = x.withColumn("_at", F.explode(F.array_compact(F.array(
        F.struct(F.col("_us").alias("t"), F.lit(False).alias("closes")), F.when(F.col("_f") & F.col("_own"), close)))))
    real_fail = F.col("_f") & ~F.col("_at.closes")
    order = [F.col("_at.t"), F.col("_at.closes"), F.col(seq)]
    so_far = part.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    from_now = part.orderBy(*(c.desc() for c in order)).rowsBetween(Window.unboundedPreceding, 0)
    fail = F.struct(F.col("_us").alias("us"), F.col(seq).alias("seq"), F.col("_opens").alias("opens"))
    real = ~F.col("_at.closes")
    x = (x.withColumn("_n_end", F.max(F.when(real, F.col("_n"))).over(so_far)).withColumn("_ok_end", F.max(F.when(real, F.col("_ok"))).over(so_far))
         .withColumn("_last", F.last(F.when(real_fail, F.col(ts)), ignorenulls=True).over(so_far))
         .withColumn("_next", F.last(F.when(real_fail, fail), ignorenulls=True).over(from_now)))
    cancelled = F.col("_ok_end") > F.col("_ok")
    near = F.col("_next.us") <= F.col("_us") + F.lit(2 * reach)
    to = F.when(~cancelled & near & ~F.col("_next.opens"), F.struct("_next.us", "_next.seq"))
    fails = x.filter("_at.closes").select(
        *keys, F.struct(F.col("_us").alias("us"), F.col(seq).alias("seq")).alias("_row"), F.col(ts).alias("first_ts"), F.col("_last").alias("last_ts"),
        (F.col("_n_end") - F.col("_n") + 1).alias("n_fails"), cancelled.alias("_cancelled"), "_opens", to.alias("_to")).checkpoint()
    links = fails.filter("_to IS NOT NULL").select(*keys, "_row", "_to")
    opened = _reached(fails.filter("_opens").select(*keys, "_row"), links, keys, "_row", "_to")
    kept = fails.filter(~F.col("_cancelled") & (F.col("n_fails") >= 2))
    same = F.lit(True)
    for c in [*keys, "_row"]:
        same &= kept[c].eqNullSafe(opened[c])
    return kept.join(opened, same, "left_semi").select(*keys, "first_ts", "last_ts", "n_fails")


def _reached(starts: DataFrame, links: DataFrame, keys: list[str], node: str, to: str) -> DataFrame:
    """(keys, node) of the starts and of all that links (keys, node, to), at most one from each node, lead to from them.

    Links double each round, so a chain of n takes log2(n) rounds of joins on
    unique rows; rounds end when no link is as long.  Links must not run in circles.
    """
    def same_row(a_node: str) -> Column:
        same = F.col(a_node) == F.col("_b_node")
        for c in keys:
            same &= F.col(c).eqNullSafe(F.col(f"_b_{c}"))
        return same

    found = starts.select(*keys, node)
    while not links.isEmpty():
        other = links.select(*(F.col(c).alias(f"_b_{c}") for c in keys), F.col(node).alias("_b_node"), F.col(to).alias("_b_to"))
        ahead = found.join(other, same_row(node)).select(*keys, F.col("_b_to").alias(node))
        found = found.unionByName(ahead).distinct().checkpoint()
        links = links.join(other, same_row(to)).select(*keys, node, F.col("_b_to").alias(to)).checkpoint()
    return found


def order_status(df: DataFrame, key, ts: str, seq: str, is_create: Column, is_pay: Column,
                 within="15 minutes", block=None) -> DataFrame:
    """T4/O3: create → pay state machine with a ``within`` timeout, event-exact.

    Only create and pay rows take part.  A pay is ``paid`` when the row
    before it is a create at most ``within`` earlier, else ``payed_timeout``.
    A create is ``no_pay`` unless the next row comes within ``within`` (a
    pay, which reports ``paid``; or a newer create, which replaces it).
    Returns ``key, create_ts, pay_ts, create_seq, pay_seq, status``.
    """
    keys = _keys(key)
    span = to_micros(within)
    base = df.select(*keys, ts, seq, is_create.alias("_c"), is_pay.alias("_p")).filter(F.col("_c") | F.col("_p"))
    b = time_blocks(base, ts, back_us=span, ahead_us=span, block=block)
    w = Window.partitionBy(*keys, "_blk").orderBy(ts, seq)
    x = b.select(*keys, ts, seq, "_c", "_p", "_us", "_own",
                 F.lag("_c").over(w).alias("_pc"), F.lag("_us").over(w).alias("_pus"),
                 F.lag(ts).over(w).alias("_pts"), F.lag(seq).over(w).alias("_pseq"),
                 F.lead("_us").over(w).alias("_nus")).filter("_own")
    paid = F.col("_p") & F.coalesce(F.col("_pc"), F.lit(False)) & (F.col("_us") - F.col("_pus") <= span)
    no_pay = F.col("_c") & (F.col("_nus").isNull() | (F.col("_nus") - F.col("_us") > span))
    null_ts = F.lit(None).cast(df.schema[ts].dataType)
    null_seq = F.lit(None).cast(df.schema[seq].dataType)
    out = x.select(
        *keys,
        F.when(paid, F.col("_pts")).when(F.col("_c"), F.col(ts)).otherwise(null_ts).alias("create_ts"),
        F.when(F.col("_p"), F.col(ts)).otherwise(null_ts).alias("pay_ts"),
        F.when(paid, F.col("_pseq")).when(F.col("_c"), F.col(seq)).otherwise(null_seq).alias("create_seq"),
        F.when(F.col("_p"), F.col(seq)).otherwise(null_seq).alias("pay_seq"),
        F.when(paid, "paid").when(F.col("_p"), "payed_timeout").when(no_pay, "no_pay").alias("status"))
    return out.filter(F.col("status").isNotNull())
