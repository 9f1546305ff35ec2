"""Unique visitors per window."""

from __future__ import annotations

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions.hashing import BITMAP_CAPACITY, bitmap_offset
from pulsekit.functions.time import floor_div, micros, micros_to, to_micros
from pulsekit.session import checkpoint_dir


def _window_cols(df: DataFrame, ts: str, size) -> tuple[Column, Column]:
    size_us = to_micros(size)
    like = df.schema[ts].dataType
    q = floor_div(micros(df, ts), size_us)
    end = (q + 1) * F.lit(size_us)
    return (micros_to(end - F.lit(size_us), like).alias("window_start"),
            micros_to(end, like).alias("window_end"))


def distinct_per_window(df: DataFrame, ts: str, id_col: str, size="1 hour", name: str = "uv") -> DataFrame:
    """A5: exact distinct ids per tumbling window.

    Spark plans ``count(DISTINCT)`` as two aggregates: ``(window, id)`` with
    map-side de-duplication, then ``window``; no id set is held in one place.
    """
    ws, we = _window_cols(df, ts, size)
    return (df.select(ws, we, F.col(id_col).alias("_id"))
            .groupBy("window_start", "window_end").agg(F.count_distinct("_id").alias(name)))


def bitmap_distinct_per_window(df: DataFrame, ts: str, id_col: str, size="1 hour", name: str = "uv",
                               capacity: int = BITMAP_CAPACITY) -> DataFrame:
    """Distinct bitmap offsets (rolling hash of the id text) per window.

    Equal to what a ``capacity``-bit bitmap per window would count: two ids
    collide exactly when their offsets agree.
    """
    ws, we = _window_cols(df, ts, size)
    return (df.select(ws, we, bitmap_offset(F.col(id_col).cast("string"), capacity).alias("_off"))
            .groupBy("window_start", "window_end").agg(F.count_distinct("_off").alias(name)))


def approx_distinct_per_window(df: DataFrame, ts: str, id_col: str, size="1 hour", name: str = "uv",
                               rsd: float = 0.01) -> DataFrame:
    """A6, bounded-memory form: HyperLogLog++ sketch per window (mergeable partials)."""
    ws, we = _window_cols(df, ts, size)
    return (df.select(ws, we, F.col(id_col).alias("_id"))
            .groupBy("window_start", "window_end").agg(F.approx_count_distinct("_id", rsd).alias(name)))


_RUN_SCHEMA = T.StructType([
    T.StructField("_q", T.LongType()), T.StructField("_seq", T.LongType()),
    T.StructField("_pid", T.IntegerType()), T.StructField("_local", T.LongType()),
])


def _local_prefix(batches):
    """Running count of first sightings per window inside one range partition, for its rows.

    Rows and sightings arrive sorted by (window, time, seq), a sighting
    before its row; the count carries across Arrow batches of one window.
    Vectorised per batch; constant state.
    """
    pid = TaskContext.get().partitionId()
    last_q, carry = None, 0
    for pdf in batches:
        if pdf.empty:
            continue
        cum = pdf.groupby("_q", sort=False)["_first"].cumsum().astype("int64")
        if last_q is not None:
            cum = cum + (pdf["_q"] == last_q).to_numpy() * carry
        pdf = pdf.assign(_pid=pid, _local=cum)
        last_q, carry = int(pdf["_q"].iloc[-1]), int(pdf["_local"].iloc[-1])
        # sightings stay, without a number, for the totals
        yield pdf.assign(_seq=pdf["_seq"].astype("Int64").where(pdf["_first"] == 0))[["_q", "_seq", "_pid", "_local"]]


def running_distinct(df: DataFrame, ts: str, id_col: str, seq: str, size="1 hour", name: str = "uv",
                     partitions: int | None = None) -> DataFrame:
    """After every row, the number of distinct ids seen so far in its window.

    Per row: ``uv`` = number of ids whose first row in the window comes at or
    before this row in (time, seq) order.

    1. First sightings: ``min(struct(time, seq))`` per (window, id), a plain
       aggregate with map-side combine.  They are put among the rows, not
       joined to them.
    2. A distributed prefix sum: range-partition rows and sightings on
       (window, time, seq) (sampled bounds, so partitions are even whatever the
       skew; what is sampled is written first and not computed twice), count
       sightings per partition with constant state, write that to the
       checkpoint folder (fixing the partition ids), then add the totals of
       earlier partitions of the same window: at most (partitions + windows)
       rows, whose join the planner chooses by their size.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    size_us = to_micros(size)
    us = micros(df, ts)
    base = df.select(floor_div(us, size_us).alias("_q"), us.alias("_us"), F.col(seq).cast("long").alias("_seq"), F.col(id_col).alias("_id"))
    first = (base.groupBy("_q", "_id").agg(F.min(F.struct("_us", "_seq")).alias("_f"))
             .select("_q", F.col("_f._us").alias("_us"), F.col("_f._seq").alias("_seq"), F.lit(1).alias("_first")))
    both = base.select("_q", "_us", "_seq", F.lit(0).alias("_first")).unionByName(first).checkpoint()
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["_q", "_us", "_seq"]
    ranged = both.repartitionByRange(n, *order).sortWithinPartitions(*order, F.col("_first").desc()).select("_q", "_seq", "_first")
    local = ranged.mapInPandas(_local_prefix, _RUN_SCHEMA).checkpoint()
    totals = local.groupBy("_pid", "_q").agg(F.max("_local").alias("_tot"))
    w = Window.partitionBy("_q").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", "_q", F.coalesce(F.sum("_tot").over(w), F.lit(0)).alias("_off"))
    like = df.schema[ts].dataType
    end = (F.col("_q") + 1) * F.lit(size_us)
    return (local.filter("_seq IS NOT NULL").join(offsets, ["_pid", "_q"])
            .select(F.col("_seq").alias(seq),
                    micros_to(end - F.lit(size_us), like).alias("window_start"),
                    micros_to(end, like).alias("window_end"),
                    (F.col("_off") + F.col("_local")).cast("long").alias(name)))
