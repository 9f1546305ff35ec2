"""Side outputs come from one pass over the input and commit together."""

import contextlib
import io

from pyspark.sql import functions as F

from pulsekit.operators.patterns import followed_by, followed_by_tagged
from pulsekit.operators.rules import cap_per_day, cap_tagged
from pulsekit.operators.tagged import read_tagged, write_tagged
from pulsekit.sources import driver as D
from pulsekit.sources.readers import parse_lines, parse_tagged
from pulsekit.sources.schemas import RAW_USER_BEHAVIOR
from tests.conftest import SF001


def scans(df) -> int:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue().count("FileScan parquet")


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_one_scan_for_all_outputs(spark, tmp_path):
    events = D.table(spark, SF001, "events")
    clicks = events.select("user_id", "event_type", "ts", F.col("event_id").alias("seq"))
    orders = D.order_events(events)
    is_first, is_then = F.col("event_type") == "create", F.col("event_type") == "pay"
    lines = D.user_behavior_lines(events).withColumn("value", F.when(F.col("seq") % 5 == 0, "broken").otherwise(F.col("value")))
    cases = {
        "cap": (cap_tagged(clicks, ["user_id", "event_type"], "ts", "seq", 3), cap_per_day(clicks, ["user_id", "event_type"], "ts", "seq", 3), ("pass", "warn")),
        "pattern": (followed_by_tagged(orders, "order_id", "ts", "seq", is_first, is_then, "12 hours"),
                    followed_by(orders, "order_id", "ts", "seq", is_first, is_then, "12 hours"), ("match", "timeout")),
        "lines": (parse_tagged(lines, RAW_USER_BEHAVIOR), parse_lines(lines, RAW_USER_BEHAVIOR), ("ok", "reject"))}
    for name, (tagged, apart, tags) in cases.items():
        assert scans(tagged) == 1
        path = str(tmp_path / name)
        write_tagged(tagged, path)
        for tag, other in zip(tags, apart, strict=True):
            want = other.drop("warning")
            got = read_tagged(spark, path, tag, want.columns)
            assert got.count() > 0 and same(got, want), (name, tag)


def test_caps_of_one_and_two(spark):
    rows = spark.createDataFrame([("u", i, i) for i in range(5)], "k string, sec long, seq long").withColumn("ts", F.timestamp_seconds("sec").cast("timestamp_ntz"))
    for cap, want in ((1, ["pass", "warn"]), (2, ["pass", "warn"]), (3, ["pass", "pass", "warn"]), (100, ["pass"] * 5)):
        assert [r.status for r in cap_tagged(rows, "k", "ts", "seq", cap).orderBy("seq").collect()] == want
