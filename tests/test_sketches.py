"""Stored bitmaps against sets of offsets."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsekit.operators.sketches import bitmap_partials, bitmap_window_counts, merged

HOUR = 3_600_000_000


def frame(spark, rows):
    return spark.createDataFrame(rows, "us long, id string").withColumn("ts", F.timestamp_micros("us").cast("timestamp_ntz"))


def plain(rows, panes):
    """Distinct last six characters per window, one row at a time; ids here are shorter or digits."""
    seen: dict = {}
    for us, id_ in rows:
        if us is not None and id_ is not None:
            for i in range(panes):
                seen.setdefault(us // HOUR - i, set()).add(id_[-6:])
    return {p: len(s) for p, s in seen.items()}


def counted(table, panes):
    got = bitmap_window_counts(table, "1 hour", panes)
    us = [F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})") for c in ("window_start", "window_end")]
    rows = got.select(us[0].alias("a"), us[1].alias("b"), "uv").collect()
    assert all(r.b - r.a == panes * HOUR for r in rows) and len({r.a for r in rows}) == len(rows)
    return {r.a // HOUR: r.uv for r in rows}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-30 * HOUR, 60 * HOUR)), st.one_of(st.none(), st.integers(0, 3000).map(lambda i: str(10**6 * (i % 5) + i)))), max_size=60),
       st.sampled_from([1, 2, 3, 5, 7, 24]))
def test_windows_of_any_length(spark, rows, panes):
    assert counted(bitmap_partials(frame(spark, rows), "ts", "id"), panes) == plain(rows, panes)


def test_partials_are_appended_and_replayed(spark, tmp_path):
    """Loads are appended without reading the table; a load that comes twice changes nothing."""
    loads = [[(i * HOUR // 3, str(7 * i)) for i in range(k, 40, 3)] for k in range(3)]
    for load in (*loads, loads[1]):
        bitmap_partials(frame(spark, load), "ts", "id").write.mode("append").parquet(str(tmp_path / "bits"))
    stored = spark.read.parquet(str(tmp_path / "bits"))
    rows = [r for load in loads for r in load]
    for panes in (1, 6):
        assert counted(stored, panes) == plain(rows, panes)
    one = merged(stored, stored)
    assert one.count() == one.select("pane", "bucket").distinct().count() < stored.count()


def test_an_empty_table_has_no_windows(spark):
    assert counted(bitmap_partials(frame(spark, []), "ts", "id"), 24) == {}
