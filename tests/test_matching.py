"""One-to-one reconciliation against one row at a time."""

import random

import pytest
from pyspark.sql import functions as F

from pulsekit.operators.matching import reconcile_one_to_one


def plain(pays, receipts, low, high):
    """(pay id, receipt id) of the pairs: each row with the earliest of the other side that still waits within the bounds."""
    rows = sorted([(t, i, "a", k) for i, k, t in pays] + [(t, i, "b", k) for i, k, t in receipts])
    rows.sort(key=lambda r: (r[0], r[1]))
    waiting, out = [], set()
    for t, i, side, key in (r for r in rows if r[3] is not None and r[0] is not None):
        for w in waiting:
            gap = (w[0] - t) if side == "a" else (t - w[0])
            if w[3] == key and w[2] != side and low <= gap <= high:
                waiting.remove(w)
                out.add((i, w[1]) if side == "a" else (w[1], i))
                break
        else:
            waiting.append((t, i, side, key))
    return out


@pytest.mark.parametrize("low,high,block", [(-3, 5, "5 seconds"), (-3, 5, None), (0, 7, "9 seconds"), (-4, 0, "4 seconds"), (0, 0, "1 second")])
def test_pairs(spark, low, high, block):
    """One busy key over many blocks, where what waits matters from block to block, and some sparse ones; leftovers on both sides."""
    r = random.Random(low * 100 + high)
    some = [("busy", r.randrange(0, 150)) for _ in range(150)] + [(f"k{r.randrange(9)}", r.randrange(0, 400)) for _ in range(60)] + [(None, 5)]
    pays = [(2 * i, k, t) for i, (k, t) in enumerate(some)]
    receipts = [(2 * i + 1, k, t + r.randrange(-5, 8)) for i, (k, t) in enumerate(some)]
    a, b = (spark.createDataFrame(x, f"{n}_id long, tx string, s long").select(f"{n}_id", "tx", F.timestamp_seconds("s").cast("timestamp_ntz").alias(f"{n}_ts"))
            for n, x in (("pay", pays), ("receipt", receipts)))
    got = reconcile_one_to_one(a, b, "tx", "pay_ts", "receipt_ts", "pay_id", "receipt_id", f"{low} seconds", f"{high} seconds", block=block).collect()
    want = plain(pays, receipts, low, high)
    assert {(x.pay_id, x.receipt_id) for x in got if x.status == "matched"} == want and want
    assert sorted(x.pay_id for x in got if x.pay_id is not None) == sorted(i for i, _, _ in pays)
    assert sorted(x.receipt_id for x in got if x.receipt_id is not None) == sorted(i for i, _, _ in receipts)
    assert all((x.status == "pay_only") == (x.receipt_id is None) and (x.status == "receipt_only") == (x.pay_id is None) for x in got)


def test_bounds_on_one_side_are_refused(spark):
    a = spark.createDataFrame([(1, "x")], "pay_id long, tx string").withColumn("pay_ts", F.timestamp_seconds(F.lit(1)))
    b = spark.createDataFrame([(1, "x")], "receipt_id long, tx string").withColumn("receipt_ts", F.timestamp_seconds(F.lit(1)))
    with pytest.raises(ValueError):
        reconcile_one_to_one(a, b, "tx", "pay_ts", "receipt_ts", "pay_id", "receipt_id", "1 second", "5 seconds")
    assert reconcile_one_to_one(a.limit(0), b.limit(0), "tx", "pay_ts", "receipt_ts", "pay_id", "receipt_id").collect() == []
