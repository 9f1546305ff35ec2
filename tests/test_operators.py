"""Operator properties checked against brute force on the small driver tables."""

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsekit.functions.keys import salt
from pulsekit.operators.distinct import running_distinct
from pulsekit.operators.patterns import consecutive, followed_by
from pulsekit.operators.rules import fail_episodes, fail_pairs, order_status
from pulsekit.operators.topn import top_n_by_count
from pulsekit.operators.windows import salted_counts, window_counts
from pulsekit.sources import driver as D
from pulsekit.sources import readers as R
from pulsekit.sources.schemas import RAW_LOGIN
from tests.conftest import SF001


@pytest.fixture(scope="module")
def events(spark):
    return D.table(spark, SF001, "events").withColumn("k", D.item_id() % 7)


def _brute_windows(pdf, keys, size_us, slide_us):
    us = (pdf["ts"] - pd.Timestamp("1970-01-01")) // pd.Timedelta(microseconds=1)
    rows = {}
    k = size_us // slide_us
    for key, u in zip(pdf[keys].itertuples(index=False, name=None), us):
        p = u // slide_us
        for q in range(p, p + k):
            rows[(key, q)] = rows.get((key, q), 0) + 1
    return sorted((key, (q + 1) * slide_us, c) for (key, q), c in rows.items())


@pytest.mark.parametrize("size,slide,block", [
    ("1 hour", "5 minutes", None), ("1 hour", "5 minutes", 12), ("10 minutes", "5 minutes", 2),
    ("1 hour", "1 hour", None), ("3 hours", "20 minutes", 9)])
def test_window_counts_match_brute_force(events, size, slide, block):
    from pulsekit.functions.time import to_micros
    got = window_counts(events, "ts", ["k", "event_type"], size, slide, block_panes=block).toPandas()
    got_us = (got["window_end"] - pd.Timestamp("1970-01-01")) // pd.Timedelta(microseconds=1)
    g = sorted(((a, b), e, c) for a, b, e, c in zip(got["k"], got["event_type"], got_us, got["cnt"]))
    want = _brute_windows(events.select("k", "event_type", "ts").toPandas(), ["k", "event_type"],
                          to_micros(size), to_micros(slide))
    assert g == want
    assert (got["window_end"] - got["window_start"] == pd.Timedelta(microseconds=to_micros(size))).all()


def test_window_counts_weight_and_empty(events, spark):
    w = window_counts(events, "ts", ["k"], "1 hour", "30 minutes", weight="value")
    total = w.agg(F.sum("cnt"), F.sum("total")).first()
    base = events.agg(F.count("*"), F.sum("value")).first()
    assert total[0] == 2 * base[0]
    assert abs(total[1] - 2 * base[1]) < 1e-6
    assert window_counts(events.limit(0), "ts", ["k"], "1 hour", "5 minutes").count() == 0


def test_row_on_window_edge(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 01:00:00' AS ts, 1 AS k")
    r = window_counts(df, "ts", ["k"], "1 hour", "30 minutes").orderBy("window_end").collect()
    assert [str(x.window_start) for x in r] == ["2024-01-01 00:30:00", "2024-01-01 01:00:00"]


def test_salted_equals_plain(events):
    a = window_counts(events, "ts", None, "1 hour").select("window_end", "cnt")
    b = salted_counts(events, "ts", "1 hour", salt("event_id", 8), 8).select("window_end", "cnt")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_top_n_ties_and_zero(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (1, "c", 5), (1, "d", 1), (2, "x", 1)],
                               "g int, key string, cnt long")
    r = top_n_by_count(df, "g", "key", "cnt", 2).orderBy("g", "rank").collect()
    assert [(x.g, x.key, x.rank) for x in r] == [(1, "a", 1), (1, "b", 2), (2, "x", 1)]
    assert top_n_by_count(df, "g", "key", "cnt", 0).count() == 0


def test_running_distinct_brute_force(events):
    pv = events.filter("event_type IN ('view', 'click')")
    got = running_distinct(pv, "ts", "user_id", "event_id", "6 hours", partitions=5).toPandas()
    pdf = pv.select("event_id", "user_id", "ts").toPandas().sort_values(["ts", "event_id"])
    pdf["w"] = pdf["ts"].dt.floor("6h")
    seen, want = {}, {}
    for r in pdf.itertuples():
        s = seen.setdefault(r.w, set())
        s.add(r.user_id)
        want[r.event_id] = len(s)
    assert dict(zip(got["event_id"], got["uv"])) == want


def test_time_blocks_do_not_change_answers(events):
    lg = D.logins(events)
    fail = F.col("event_type") == "fail"

    def same(a, b):
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    assert same(fail_pairs(lg, "user_id", "ts", "seq", fail, "20 hours", block="1 day"),
                fail_pairs(lg, "user_id", "ts", "seq", fail, "20 hours", block="1000 days"))
    assert same(consecutive(lg, "user_id", "ts", "seq", fail, 2, "30 hours", block="31 hours"),
                consecutive(lg, "user_id", "ts", "seq", fail, 2, "30 hours", block="1000 days"))
    od = D.order_events(events)
    c, p = F.col("event_type") == "create", F.col("event_type") == "pay"
    assert same(order_status(od, "order_id", "ts", "seq", c, p, "20 hours", block="20 hours"),
                order_status(od, "order_id", "ts", "seq", c, p, "20 hours", block="1000 days"))
    assert same(fail_episodes(lg, "user_id", "ts", "seq", fail, "8 hours", block="10 hours"),
                fail_episodes(lg, "user_id", "ts", "seq", fail, "8 hours", block="1000 days"))
    m1, t1 = followed_by(od, "order_id", "ts", "seq", c, p, "20 hours", block="20 hours")
    m2, t2 = followed_by(od, "order_id", "ts", "seq", c, p, "20 hours", block="1000 days")
    assert same(m1, m2) and same(t1, t2)


def test_followed_by_complements(events):
    od = D.order_events(events)
    c, p = F.col("event_type") == "create", F.col("event_type") == "pay"
    m, t = followed_by(od, "order_id", "ts", "seq", c, p, "12 hours")
    assert m.count() + t.count() == od.filter(c).count()


def test_reader_rejects_and_failfast(spark, tmp_path):
    f = tmp_path / "l.csv"
    f.write_text("1,1.1.1.1,fail,100\nx,1.1.1.1,fail,100\n2,1.1.1.1,success\n3,,success,5\n")
    rows, bad = R.read_logins(spark, str(f))
    assert sorted(r.user_id for r in rows.collect()) == [1, 3]
    assert bad.count() == 2
    with pytest.raises(Exception):
        R.read_csv(spark, str(f), RAW_LOGIN, mode="FAILFAST")[0].collect()


def test_access_log_space_separated(spark):
    lines = spark.createDataFrame([("83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/",),
                                   ("83.149.9.216 - - bad-time +0000 GET /x",)], "value string")
    rows, bad = R.parse_access_log(lines, sep=" ")
    assert [x.value for x in bad.collect()] == ["83.149.9.216 - - bad-time +0000 GET /x"]
    r = rows.collect()
    assert len(r) == 1 and str(r[0].ts) == "2015-05-17 10:05:03" and r[0].method == "GET"


def test_render_top_n(spark):
    from pulsekit.functions.render import render_top_n
    df = spark.createDataFrame([("2024-01-01 01:00:00", 1, 7, 5), ("2024-01-01 01:00:00", 2, 9, 3)],
                               "we string, rank int, item_id long, cnt long").selectExpr(
        "CAST(we AS TIMESTAMP_NTZ) AS window_end", "rank", "item_id", "cnt")
    text = render_top_n(df, "window_end", "rank", "item_id", "cnt").first().text
    assert text.splitlines() == ["====2024-01-01 01:00:00.0====", "Top1 ItemId:7 Count:5", "Top2 ItemId:9 Count:3"]


def plain_episodes(rows, reach):
    """Episodes of one key, one row (second, seq, is_fail) at a time."""
    out, open_ = [], None
    for t, _, fail in sorted(rows):
        if open_ and t > open_[0] + reach:
            out.append(open_)
            open_ = None
        if not fail:
            open_ = None
        elif open_:
            open_ = (open_[0], t, open_[2] + 1)
        else:
            open_ = (t, t, 1)
    return sorted(e for e in [*out, *([open_] if open_ else [])] if e[2] >= 2)


def episodes(spark, keyed, reach, **how):
    rows = [(k, t, s, f) for k, some in keyed.items() for t, s, f in some]
    df = spark.createDataFrame(rows, "k string, sec long, seq long, f boolean").withColumn("ts", F.timestamp_seconds("sec").cast("timestamp_ntz"))
    got = fail_episodes(df, "k", "ts", "seq", F.col("f"), f"{reach} seconds", **how)
    sec = {c: F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})").alias(c) for c in ("first_ts", "last_ts")}
    return sorted((r.k or "", r.first_ts, r.last_ts, r.n_fails) for r in got.select("k", *sec.values(), "n_fails").collect())


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.sampled_from([True, True, True, True, False])), max_size=80), st.integers(1, 9), st.sampled_from([None, "9 seconds", "31 seconds"]))
def test_episodes_of_any_rows(spark, rows, reach, block):
    """Ties, successes inside and at the very close, chains over many blocks."""
    some = [(t, i, f) for i, (t, f) in enumerate(rows)]
    assert episodes(spark, {"x": some, None: some[::2]}, reach, block=block) == sorted(
        [("x", *e) for e in plain_episodes(some, reach)] + [("", *e) for e in plain_episodes(some[::2], reach)])


def test_a_long_run_of_fails(spark):
    """One island of 4,000 fails with two rhythms that never meet, cut into blocks of a few rows each."""
    some = [(3 * i + (i % 7 == 0), i, True) for i in range(4000)]
    assert episodes(spark, {"x": some}, 10, block="50 seconds") == [("x", *e) for e in plain_episodes(some, 10)]
