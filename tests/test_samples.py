"""Readers and rules on small line files: a few fixed sample rows with known answers, and own rows for the edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsekit.functions.hashing import bitmap_offset
from pulsekit.functions.render import render_top_n
from pulsekit.functions.time import parse_log_time
from pulsekit.operators.joins import interval_join, reconcile
from pulsekit.operators.rules import fail_episodes, fail_pairs
from pulsekit.plans import jobs
from pulsekit.sources import readers as R

P = 1558430000
# Sample rows that the known answers rest on, in file order.
LOGINS = """1035,83.149.9.216,fail,1558430842
1035,83.149.9.216,fail,1558430845
1035,83.149.9.216,fail,1558430843
1035,83.149.24.26,fail,1558430844
1035,83.149.24.26,fail,1558430846
"""
ORDERS = """34729,create,,1558430842
34730,create,,1558430843
34729,pay,sd76f87d6,1558430844
34730,pay,3hu3k2432,1558430845
34746,create,,1558430892
34747,create,,1558430893
34746,pay,3243hr9h9,1558430895
34747,pay,329d09f9f,1558430893
34756,create,,1558430913
34767,create,,1558430949
34768,pay,88snrn932,1558430950
34756,pay,9032n4fd2,1558431951
34767,pay,sdafen9932,1558432021
"""
RECEIPTS = """sd76f87d6,wechat,1558430847
3hu3k2432,alipay,1558430848
3243hr9h9,wechat,1558430892
329d09f9f,alipay,1558430893
own1,wechat,1558430950
"""


def lines(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def _secs(rows, *cols):
    return [tuple(int(r[c].timestamp()) - P if hasattr(r[c], "timestamp") else r[c] for c in cols) for r in rows]


@pytest.fixture
def orders(spark, tmp_path):
    return R.read_orders(spark, lines(tmp_path, "orders.csv", ORDERS))[0]


@pytest.fixture
def receipts(spark, tmp_path):
    return R.read_receipts(spark, lines(tmp_path, "receipts.csv", RECEIPTS))[0]


@pytest.fixture
def logins(spark, tmp_path):
    return R.read_logins(spark, lines(tmp_path, "logins.csv", LOGINS + "7,10.0.0.1,success,1558430850\n"))[0]


def test_readers(spark, tmp_path, orders):
    assert orders.filter("event_type = 'create' AND tx_id IS NOT NULL").count() == 0
    assert orders.filter("event_type = 'pay' AND tx_id IS NULL").count() == 0
    rows, bad = R.read_user_behavior(spark, lines(tmp_path, "ub.csv", "1,20,3,pv,1511658000\n1,x,3,pv,1511658000\n2,21,3,buy,1511658001\n"))
    assert [(r.user_id, r.item_id, r.behavior) for r in rows.orderBy("seq").collect()] == [(1, 20, "pv"), (2, 21, "buy")]
    assert [r.value for r in bad.collect()] == ["1,x,3,pv,1511658000"]
    rows, bad = R.read_market(spark, lines(tmp_path, "m.csv", "5,CLICK,wechat,1511658000500\n6,INSTALL,tieba,\n"))
    assert [(r.channel, r.ts) for r in rows.collect()] == [("wechat", dt.datetime(2017, 11, 26, 1, 0, 0, 500_000))]
    assert bad.count() == 1
    rows, bad = R.read_ad_clicks(spark, lines(tmp_path, "ads.csv", "1,2,beijing,beijing,1511658000\n"))
    assert rows.count() == 1 and bad.count() == 0
    rows, bad = R.read_access_log(spark, lines(tmp_path, "log.csv", "1.2.3.4,u,-,17/05/2015:10:05:03,+0000,GET,/a\n1.2.3.4,u,-,17/05:10,+0000,GET,/a\n"))
    assert [(r.url, r.ts) for r in rows.collect()] == [("/a", dt.datetime(2015, 5, 17, 10, 5, 3))] and bad.count() == 1


def test_arrival_follows_the_files(spark, tmp_path):
    """A small first file and a large second one, which Spark packs first."""
    (tmp_path / "in").mkdir()
    lines(tmp_path / "in", "day1.csv", "1,10.0.0.1,fail,100\n2,10.0.0.1,fail,101\n")
    lines(tmp_path / "in", "day2.csv", "".join(f"{i},10.0.0.1,fail,{i}\n" for i in range(3, 3000)))
    rows = R.read_logins(spark, str(tmp_path / "in"))[0].orderBy("seq").collect()
    assert [r.user_id for r in rows] == list(range(1, 3000)) and len({r.seq for r in rows}) == len(rows)


def test_log_time_needs_no_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("10/03/2024:02:30:00",), ("32/01/2024:00:00:00",), ("x",), (None,)], "t string")
        got = [r.s for r in df.select(parse_log_time("t").cast("string").alias("s")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2024-03-10 02:30:00", None, None, None]


def test_interval_join(orders, receipts):
    got = sorted((r.order_id, r.tx, int(r.pay_ts.timestamp()), int(r.receipt_ts.timestamp()))
                 for r in jobs.pay_receipt_join(orders, receipts).collect())
    assert got == [(34729, "sd76f87d6", 1558430844, 1558430847), (34730, "3hu3k2432", 1558430845, 1558430848),
                   (34746, "3243hr9h9", 1558430895, 1558430892), (34747, "329d09f9f", 1558430893, 1558430893)]


def test_reconcile_at_the_bounds(spark, orders, receipts):
    counts = {x.status: x["count"] for x in jobs.pay_receipt_reconcile(orders, receipts).groupBy("status").count().collect()}
    assert counts == {"matched": 4, "pay_only": 3, "receipt_only": 1}
    t = "timestamp_seconds(t) "
    pays = spark.createDataFrame([("a", 1, 100), ("b", 2, 100), ("b", 3, 101), (None, 4, 100)], "tx string, pay_id long, t long").selectExpr("tx", "pay_id", t + "pay_ts")
    for gap, hit in ((-4, False), (-3, True), (0, True), (5, True), (6, False)):
        got = spark.createDataFrame([("a", 9, 100 + gap)], "tx string, rec_id long, t long").selectExpr("tx", "rec_id", t + "rec_ts")
        out = reconcile(pays.filter("pay_id = 1"), got, "tx", "pay_ts", "rec_ts", "pay_id", "rec_id")
        assert sorted(r.status for r in out.collect()) == (["matched"] if hit else ["pay_only", "receipt_only"])
        assert interval_join(pays, got, "tx", "pay_ts", "rec_ts").count() == int(hit)
    twice = spark.createDataFrame([("b", 9, 102), (None, 8, 100)], "tx string, rec_id long, t long").selectExpr("tx", "rec_id", t + "rec_ts")
    out = reconcile(pays, twice, "tx", "pay_ts", "rec_ts", "pay_id", "rec_id")
    assert sorted((r.status, r.pay_id or 0, r.rec_id or 0) for r in out.collect()) == [
        ("matched", 2, 9), ("matched", 3, 9), ("pay_only", 1, 0), ("pay_only", 4, 0), ("receipt_only", 0, 8)]


def test_order_patterns(spark, orders):
    matches, late = jobs.order_pay_pattern(orders, "15 minutes")
    assert matches.count() == 4 and sorted(x.order_id for x in late.collect()) == [34756, 34767]
    by = {}
    for r in jobs.order_pay_state(orders, "15 minutes").collect():
        by.setdefault(r.status, []).append(r.order_id)
    assert {k: sorted(v) for k, v in by.items()} == {
        "paid": [34729, 34730, 34746, 34747], "no_pay": [34756, 34767], "payed_timeout": [34756, 34767, 34768]}


def test_fifteen_minutes_to_the_second(spark):
    """899, 900 and 901 s: the pattern is strict, the state machine is not."""
    rows = [(i, e, 1000 + d, s) for i, gap in enumerate((899, 900, 901)) for s, (e, d) in enumerate((("create", 0), ("pay", gap)))]
    rows += [(5, "pay", 10, 0), (5, "create", 20, 1), (6, "create", 10, 0), (6, "create", 20, 1), (6, "pay", 30, 2), (7, "create", 10, 0), (7, "pay", 10, 1), (7, "pay", 12, 2)]
    df = spark.createDataFrame(rows, "order_id long, event_type string, t long, seq long").selectExpr("order_id", "event_type", "timestamp_seconds(t) ts", "seq")
    matches, late = jobs.order_pay_pattern(df, "15 minutes")
    assert sorted(r.order_id for r in matches.collect()) == [0, 6, 6, 7] and sorted(r.order_id for r in late.collect()) == [1, 2, 5]
    got = sorted((r.order_id, r.status) for r in jobs.order_pay_state(df, "15 minutes").collect())
    assert got == [(0, "paid"), (1, "paid"), (2, "no_pay"), (2, "payed_timeout"), (5, "no_pay"), (5, "payed_timeout"),
                   (6, "paid"), (7, "paid"), (7, "payed_timeout")]


def test_fail_pairs(spark, logins):
    arrival = jobs.login_fail_pairs(logins, "2 seconds", order="arrival").collect()
    assert sorted(_secs(arrival, "first_ts", "last_ts")) == [(843, 844), (844, 846), (845, 843)]
    assert jobs.login_fail_pairs(logins, "2 seconds", order="event").count() == 4
    split = fail_pairs(logins.withColumn("seq", F.col("seq") % 1000), "user_id", "ts", "seq", F.col("event_type") == "fail", "2 seconds",
                       order="arrival", seq_block=40)
    assert sorted(_secs(split.collect(), "first_ts", "last_ts")) == [(843, 844), (844, 846), (845, 843)]


def test_runs(logins):
    five = jobs.login_fail_runs(logins, 5, "5 seconds").collect()
    assert [(a, b, r.n_events) for (a, b), r in zip(_secs(five, "first_ts", "last_ts"), five, strict=True)] == [(842, 846, 5)]
    assert jobs.login_fail_runs(logins, 2, "2 seconds").count() == 4
    assert jobs.login_fail_runs(logins, 5, "4 seconds").count() == 0  # a span of exactly 4 s is out


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_fail_episodes(logins, kind):
    rows = logins.withColumn("ts", F.col("ts").cast(kind))

    def run(**how):
        got = fail_episodes(rows, "user_id", "ts", "seq", F.col("event_type") == "fail", "2 seconds", **how).collect()
        return sorted((a, b, r.n_fails) for (a, b), r in zip(_secs(got, "first_ts", "last_ts"), got, strict=True))

    assert run() == run(block="3 seconds") == [(842, 844, 3), (845, 846, 2)]
    assert run(grace="5 seconds") == run(grace="5 seconds", block="7 seconds") == [(842, 846, 5)]


@pytest.mark.parametrize("cap,passes,warned", [(1, 1, 2), (2, 1, 2), (3, 2, 3), (100, 99, 100), (500, 130, None)])
def test_click_cap(spark, cap, passes, warned):
    df = spark.createDataFrame([(1, 2, "p", 1511658000 + i, i) for i in range(130)], "user_id long, ad_id long, province string, t long, seq long")
    clicks = df.selectExpr("user_id", "ad_id", "province", "cast(timestamp_seconds(t) as timestamp_ntz) ts", "seq")
    passed, warn = jobs.ad_click_cap(clicks, cap)
    assert passed.count() == passes and [r.seq + 1 for r in warn.collect()] == ([] if warned is None else [warned])
    per = jobs.ad_clicks_by_province(clicks, cap).agg(F.sum("cnt")).first()[0]
    assert per == passes * 720


def test_hash_offsets(spark):
    df = spark.createDataFrame([("561558",), ("1234567",), ("9234567",), ("",)], "s string")
    got = [r.o for r in df.select(bitmap_offset("s").alias("o")).collect()]
    assert got[0] == 762927832 and got[1] == got[2] and got[3] == 0


def test_rendering(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1), 2, 7, 5), (dt.datetime(2020, 1, 1), 1, 9, 8)], "w timestamp_ntz, r int, k long, c long")
    (row,) = render_top_n(df, "w", "r", "k", "c").collect()
    assert row.text.splitlines()[0].startswith("====2020-01-01") and len(row.text.splitlines()) == 3
