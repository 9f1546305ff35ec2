"""Interval join (J1) and two-stream reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.time import floor_div, micros, to_micros


def interval_join(left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str,
                  lower="-3 seconds", upper="5 seconds", bucket=None) -> DataFrame:
    """Pairs with equal keys and ``right_ts`` in ``[left_ts + lower, left_ts + upper]`` (both ends inclusive).

    Besides the key, both sides are joined on a time bucket of width
    ``upper - lower``: each right row has one bucket, each left row the (at
    most two) buckets its interval touches.  A key with many rows then only
    meets rows of nearby buckets, so the work follows the number of pairs
    found, not the square of the key's size; every pair is found once.
    Column names of the two sides must not clash, except the ``on`` keys.
    """
    on = [on] if isinstance(on, str) else list(on)
    lo, hi = to_micros(lower), to_micros(upper)
    width = to_micros(bucket) if bucket else max(hi - lo, 1)
    lus, rus = micros(left, left_ts), micros(right, right_ts)
    l2 = left.withColumn("_lus", lus).withColumn(
        "_bk", F.explode(F.sequence(floor_div(F.col("_lus") + F.lit(lo), width),
                                    floor_div(F.col("_lus") + F.lit(hi), width))))
    r2 = right.withColumn("_rus", rus).withColumn("_bk", floor_div(F.col("_rus"), width))
    cond = [l2[k] == r2[k] for k in on] + [
        l2["_bk"] == r2["_bk"],
        r2["_rus"] >= l2["_lus"] + F.lit(lo),
        r2["_rus"] <= l2["_lus"] + F.lit(hi),
    ]
    j = l2.join(r2, cond, "inner")
    keep = [l2[k] for k in on] + [l2[c] for c in left.columns if c not in on] + \
           [r2[c] for c in right.columns if c not in on]
    return j.select(*keep)


def _near(one: DataFrame, one_ts: str, many: DataFrame, many_ts: str, on: list[str], lo: int, hi: int, how: str) -> DataFrame:
    """``one`` joined with the rows of ``many`` whose time is in ``[one + lo, one + hi]``.

    Here ``many`` is copied into the (at most two) buckets whose rows can
    reach it and ``one`` keeps its own bucket, so each of its rows is there
    once and outer and anti joins are right as they stand.
    """
    width = max(hi - lo, 1)
    o = one.withColumn("_o", micros(one, one_ts)).withColumn("_bk", floor_div(F.col("_o"), width))
    m = (many.withColumnsRenamed({k: f"_m_{k}" for k in on}).withColumn("_m", micros(many, many_ts))
         .withColumn("_mbk", F.explode(F.sequence(floor_div(F.col("_m") - F.lit(hi), width), floor_div(F.col("_m") - F.lit(lo), width)))))
    gap = F.col("_m") - F.col("_o")
    cond = (F.col("_bk") == F.col("_mbk")) & (gap >= lo) & (gap <= hi)
    for k in on:
        cond &= o[k] == m[f"_m_{k}"]
    return o.join(m, cond, how)


def reconcile(pays: DataFrame, receipts: DataFrame, on, pay_ts: str, receipt_ts: str,
              pay_id: str, receipt_id: str, lower="-3 seconds", upper="5 seconds",
              status: str = "status") -> DataFrame:
    """Full reconciliation: matched pairs, pays without receipt, receipts without pay.

    One left outer join by key, time bucket and range gives the pairs and the
    pays alone, one anti join the receipts alone; no hot key, no duplicates
    from the buckets.  Status values: ``matched``, ``pay_only``,
    ``receipt_only``.  The m:n join is the default meaning; one-to-one
    matching is the streaming processor's job.
    """
    on = [on] if isinstance(on, str) else list(on)
    lo, hi = to_micros(lower), to_micros(upper)
    left = [c for c in pays.columns if c not in on]
    right = [c for c in receipts.columns if c not in on]
    paid = _near(pays, pay_ts, receipts, receipt_ts, on, lo, hi, "left").select(
        *on, *left, *right, F.when(F.col("_m").isNull(), "pay_only").otherwise("matched").alias(status))
    alone = _near(receipts, receipt_ts, pays, pay_ts, on, -hi, -lo, "left_anti")
    return paid.unionByName(alone.select(*on, *(F.lit(None).cast(pays.schema[c].dataType).alias(c) for c in left), *right,
                                         F.lit("receipt_only").alias(status)))
