"""One-to-one reconciliation of two time-ordered sides.

Rows of one key are taken in (time, id) order.  Each matches the earliest row
of the other side that still waits and lies within the bounds, else it waits
itself; a row that no later one can reach is left over.

A key's rows are cut into time blocks at least as long as the reach, so all
that a block inherits is the rows that wait at the end of the one before it.
Blocks are matched side by side, first as if nothing waited; those that were
wrong about it are matched again, until none is.  What waits is usually settled
within a block (whenever nobody waits, the past is forgotten), so few blocks
run twice; the worst case is a round per block of a key, never a wrong match.
A task holds the rows that wait, not a key's rows.
"""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions.time import floor_div, micros, to_micros
from pulsekit.session import checkpoint_dir

_OUT = "pair boolean, us long, id long, is_left boolean, other_us long, other_id long"


def _matcher(low: int, high: int, size: int):
    """Rows sorted by (key, block, inherited first, time, id) → the pairs made and, per block, who waits at its end."""
    def run(batches):
        block, waiting = None, deque()

        def ends():
            end = (block[1] + 1) * size
            return [(*block, False, us, id_, left, None, None) for us, id_, left in waiting if us + (high if left else -low) >= end]

        for b in batches:
            out = []
            for key, blk, inherited, us, id_, left in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block != (key, blk):
                    out += ends() if block is not None else []
                    block, waiting = (key, blk), deque()
                if not inherited:
                    while waiting and waiting[0][0] + (high if waiting[0][2] else -low) < us:
                        waiting.popleft()
                    if waiting and waiting[0][2] != left:
                        other = waiting.popleft()
                        out.append((key, blk, True, us, id_, left, *other[:2]))
                        continue
                waiting.append((us, id_, left))
            yield _batch(out, b.schema.field(0).type)
        if block is not None:
            yield _batch(ends(), b.schema.field(0).type)

    return run


def _batch(rows: list[tuple], key_type) -> pa.RecordBatch:
    types = [key_type, pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      ["key", "blk", "pair", "us", "id", "is_left", "other_us", "other_id"])


def one_to_one_pairs(rows: DataFrame, lower, upper, block=None) -> DataFrame:
    """(key, us, id, is_left) → left_id and right_id of each pair; ``lower <= right - left <= upper``, bounds on both sides of zero."""
    low, high = to_micros(lower), to_micros(upper)
    if not low <= 0 <= high:
        raise ValueError("the bounds must include zero")  # else rows of both sides could wait at once
    checkpoint_dir(rows.sparkSession)
    reach = max(high, -low, 1)
    size = max(to_micros(block), reach) if block else 64 * reach
    rows = rows.select("key", floor_div(F.col("us"), size).alias("blk"), F.lit(False).alias("inherited"), "us", "id", "is_left").checkpoint()
    schema = T.StructType([rows.schema["key"], *T.StructType.fromDDL("blk long, " + _OUT).fields])
    order = ["key", "blk", "inherited", "us", "id"]
    blocks = rows.select("key", "blk").distinct().checkpoint()

    def matched(some: DataFrame) -> DataFrame:
        by = [F.col(c).desc() if c == "inherited" else F.col(c) for c in order]
        return some.repartition("key", "blk").sortWithinPartitions(*by).mapInArrow(_matcher(low, high, size), schema).checkpoint()

    done = matched(rows)
    told = None     # what each block was told to inherit
    while True:
        tells = (done.filter("NOT pair").select("key", (F.col("blk") + 1).alias("blk"), F.lit(True).alias("inherited"), "us", "id", "is_left")
                 .join(blocks, ["key", "blk"], "left_semi").checkpoint())
        news = tells if told is None else tells.exceptAll(told).unionByName(told.exceptAll(tells))
        wrong = news.select("key", "blk").distinct().checkpoint()
        if wrong.isEmpty():
            break
        again = rows.unionByName(tells).join(wrong, ["key", "blk"], "left_semi")
        done = done.join(wrong, ["key", "blk"], "left_anti").unionByName(matched(again)).checkpoint()
        told = tells
    pairs = done.filter("pair")
    return pairs.select(F.when(F.col("is_left"), F.col("id")).otherwise(F.col("other_id")).alias("left_id"),
                        F.when(F.col("is_left"), F.col("other_id")).otherwise(F.col("id")).alias("right_id"))


def reconcile_one_to_one(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str, left_id: str, right_id: str,
                         lower="-3 seconds", upper="5 seconds", left_only="pay_only", right_only="receipt_only", block=None) -> DataFrame:
    """Pairs and leftovers of two sides: ``on``, the left side's columns, the right side's, ``status``.

    Ids are whole numbers, unique within their side.  Rows of one time are
    taken by id, on a tie of both the left one first.  Rows without a key or
    a time match nothing and are left over.
    """
    sides = [df.select(F.col(on).alias("key"), micros(df, ts).alias("us"), F.col(i).cast("long").alias("id"), F.lit(is_left).alias("is_left"))
             for df, ts, i, is_left in ((left, left_ts, left_id, True), (right, right_ts, right_id, False))]
    usable = sides[0].unionByName(sides[1]).filter("key IS NOT NULL AND us IS NOT NULL")
    pairs = one_to_one_pairs(usable, lower, upper, block)
    lefts = [c for c in left.columns if c != on]
    rights = [c for c in right.columns if c != on]
    r = right.withColumnRenamed(on, "_on")
    both = (left.join(pairs, left[left_id] == pairs["left_id"], "left").join(r, F.col("right_id") == r[right_id], "full"))
    status = F.when(F.col("left_id").isNotNull(), "matched").when(F.col(left_id).isNull(), right_only).otherwise(left_only)
    return both.select(F.coalesce(on, "_on").alias(on), *lefts, *rights, status.alias("status"))
