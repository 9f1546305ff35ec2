"""Streaming twins of driver queries: the same answer through Structured Streaming.

Each query streams the whole ``events`` table, drains it, closes its input,
writes parquet under the checkpoint folder, and returns that table with the
batch query's schema.  ``max_files`` bounds the files of a micro-batch and
``delay`` the disorder between them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.operators.topn import top_n_by_count
from pulsekit.operators.windows import window_counts
from pulsekit.session import ensure_utc, scratch_path
from pulsekit.sources import driver as D
from pulsekit.streaming import processors as P
from pulsekit.streaming.ingest import stamp_ingest
from pulsekit.streaming.io import Ending, arrivals, read_table_stream, run_batches_to_table, run_each, run_to_table
from pulsekit.streaming.late import DROPPED, latest, stream_late_windows, stream_top_n
from pulsekit.streaming.plans import (stream_distinct_per_window, stream_interval_join, stream_reconcile, stream_window_counts)
from pulsekit.streaming.runs import stream_window_runs, windows_of
from pulsekit.streaming.running import running_counts, stream_running_distinct
from pulsekit.streaming.upsert import UpsertTable

# The batch queries' parameters.
TOP_N, CAP = 3, 3
PAIR_GAP, RUN_N, RUN_WITHIN, ORDER_WITHIN = "2 hours", 3, "24 hours", "12 hours"
JOIN_LOWER, JOIN_UPPER = "-3 hours", "5 hours"


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def _us(name: str, alias: str):
    return F.timestamp_micros(name).cast("timestamp_ntz").alias(alias)


def _views(spark, sf, ending, max_files, delay, *extra) -> DataFrame:
    ev = read_table_stream(spark, sf, "events", max_files)
    return ending.close(ev.filter(F.col("event_type") == "view").select("ts", "user_id", *extra), "ts", delay)


def q_stream_pv_hourly(spark, sf, max_files=None, delay="0 seconds"):
    end = Ending(spark, at_once=not max_files)
    counts = stream_window_counts(_views(spark, sf, end, max_files, delay), "ts", None, "1 hour", name="pv")
    return _ntz(run_to_table(counts, "stream_pv_hourly", end), "window_start", "window_end")


def q_stream_hot_items_topn(spark, sf, max_files=None, delay="0 seconds"):
    end = Ending(spark, at_once=not max_files)
    views = _views(spark, sf, end, max_files, delay, D.item_id().alias("item_id"))
    # a window's counts all come in the micro-batch in which the watermark passes it: each is ranked by a batch query, without state
    counts = stream_window_counts(views, "ts", "item_id", "1 hour", "5 minutes")
    out = run_batches_to_table(counts, "stream_hot_items", lambda b: top_n_by_count(b, "window_end", "item_id", "cnt", TOP_N), end)
    return _ntz(out, "window_end").select("window_end", "rank", "item_id", "cnt")


def _ranked(lists: DataFrame, key: str) -> DataFrame:
    """The last revision of each window end's list."""
    return latest(lists, ["window_end"], "revision").select(_us("window_end", "window_end"), "rank", key, "cnt")


# The hot-url job's disorder and lateness.
URL_DELAY, URL_LATENESS, URL_SIZE, URL_SLIDE = "2 seconds", "60 seconds", "10 minutes", "5 minutes"


def _gets(events: DataFrame) -> DataFrame:
    """GET requests of the access log: its times are whole seconds."""
    url = F.concat(F.lit("/item/"), D.item_id().cast("string"))
    return events.filter(F.col("event_type").isin("click", "view")).select(F.date_trunc("second", "ts").alias("ts"), url.alias("url"), F.col("event_id").alias("seq"))


def q_stream_hot_urls_topn(spark, sf, max_files=None, delay=URL_DELAY):
    end = Ending(spark, at_once=not max_files)
    gets = end.close(_gets(read_table_stream(spark, sf, "events", max_files)).select("ts", "url"), "ts", delay)
    counts = stream_late_windows(gets, "ts", "url", URL_SIZE, URL_SLIDE, URL_LATENESS).filter(F.col("kind") != DROPPED)
    return _ranked(run_to_table(stream_top_n(counts, "url", TOP_N, URL_LATENESS), "stream_hot_urls", end), "url")


# Late arrivals: time runs 600 times faster (a month in 72 minutes), odd events come 45 s late and some an hour.
URL_FASTER, URL_LOADS = 600, 3


def late_requests(events: DataFrame) -> tuple[DataFrame, int]:
    """Requests with the load that each arrives in, and the number of loads; loads end 20 s after a window does."""
    us = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / URL_FASTER)
    wait = F.when(F.col("seq") % 29 == 5, 3_600_000_000).when(F.col("seq") % 2 == 1, 45_000_000).otherwise(0)
    rows = _gets(events).select(us.alias("us"), "url", (us + wait - 20_000_000).alias("at"))
    low, high = rows.agg(F.min("at"), F.max("at")).first()
    if low is None:
        return rows.select(F.timestamp_micros("us").alias("ts"), "url", F.lit(0).alias("load")), 0
    period = ((high - low) // URL_LOADS // 300_000_000 + 1) * 300_000_000
    first, last = low // period, high // period
    return rows.select(F.timestamp_micros("us").alias("ts"), "url", (F.floor(F.col("at") / period) - first).cast("int").alias("load")), last - first + 1


def q_stream_hot_urls_late(spark, sf):
    """Each url's windows when rows come late: the last count, how often it was corrected, and rows that came too late."""
    ensure_utc(spark)
    rows, loads = late_requests(D.table(spark, sf, "events"))
    path, out, progress = (scratch_path(spark, f"late-{n}") for n in ("in", "out", "progress"))
    end = Ending(spark)
    rows.filter("load < 0").drop("load").write.parquet(path)
    stream = end.close(spark.readStream.schema("ts timestamp, url string").parquet(path), "ts", URL_DELAY)
    counts = stream_late_windows(stream, "ts", "url", URL_SIZE, URL_SLIDE, URL_LATENESS)
    for _ in arrivals(rows, "load", loads, path):
        run_to_table(counts, "late", out=out, checkpoint=progress)
    log = run_to_table(counts, "late", end, out=out, checkpoint=progress)
    gone = F.col("kind") == DROPPED
    return log.groupBy("url", "window_end").agg(
        F.coalesce(F.max(F.when(~gone, F.col("cnt"))), F.lit(0)).alias("cnt"), F.coalesce(F.max("version"), F.lit(0)).alias("corrections"),
        F.coalesce(F.sum(F.when(gone, F.col("cnt"))), F.lit(0)).alias("dropped")).withColumn("window_end", F.timestamp_micros("window_end").cast("timestamp_ntz"))


def q_stream_channel_ingest(spark, sf, max_files=None):
    """Channels by ingest time: rows of all windows, and whether windows replayed from the stored times are those of the stream."""
    events = D.market_behavior(read_table_stream(spark, sf, "events", max_files)).select("channel", "behavior")
    path = scratch_path(spark, "ingest")
    stored = stamp_ingest(events, path, scratch_path(spark, "ingest-progress"))
    end, keys, windows = Ending(spark, at_once=not max_files), ["channel", "behavior"], ("1 minute", "5 seconds")
    again = window_counts(stored, "ingest_ts", keys, *windows).withColumnRenamed("cnt", "again")
    stream = end.close(spark.readStream.schema(stored.schema).parquet(path), "ingest_ts")
    live = run_to_table(stream_window_counts(stream, "ingest_ts", keys, *windows), "stream_channel_ingest", end)
    both = live.join(again, [*keys, "window_start", "window_end"], "full")
    same = F.coalesce(F.col("cnt") == F.col("again"), F.lit(False))
    return both.groupBy(*keys).agg((F.sum("cnt") / 12).cast("long").alias("cnt"), F.min(same).alias("replayed"))


def q_stream_channel_counts(spark, sf, max_files=None, delay="0 seconds"):
    end, keys = Ending(spark, at_once=not max_files), ["channel", "behavior"]
    events = D.market_behavior(read_table_stream(spark, sf, "events", max_files)).select("ts", *keys)
    runs = stream_window_runs(end.close(events, "ts", delay), "ts", keys, "1 hour", "5 seconds")
    return windows_of(run_to_table(runs, "stream_channel_counts", end), keys, "1 hour", "5 seconds")


def q_stream_ad_province_counts(spark, sf, max_files=None, delay="0 seconds"):
    """Clicks that pass the daily cap, located by a join with a table, counted in windows: two state machines in a row."""
    end = Ending(spark, at_once=not max_files)
    clicks = D.clicks(read_table_stream(spark, sf, "events", max_files))
    passed = P.stream_click_cap(end.close(clicks, "ts", delay), "user_id", "ad_id", "ts", "seq", CAP).filter("status = 'pass'")
    located = D.located(passed.select("user_id", "ts_us"), D.table(spark, sf, "customer"), D.table(spark, sf, "nation"))
    runs = stream_window_runs(located, None, "province", "1 hour", "5 seconds", us="ts_us")
    return windows_of(run_to_table(runs, "stream_ad_province", end), "province", "1 hour", "5 seconds")


def q_stream_pv_upsert(spark, sf):
    """Hourly views in update mode: each load changes some hours, an upsert table keeps the last count of each."""
    ensure_utc(spark)
    views = D.table(spark, sf, "events").filter("event_type = 'view'").select(F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 3).alias("load"))
    path, progress = scratch_path(spark, "upsert-in"), scratch_path(spark, "upsert-progress")
    table = UpsertTable(spark, scratch_path(spark, "upsert"), "window_start timestamp, window_end timestamp, pv long", ["window_start", "window_end"],
                        buckets=4, compact_every=2)
    views.filter("load < 0").drop("load").write.parquet(path)
    stream = spark.readStream.schema("ts timestamp").parquet(path)
    counts = stream.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("pv")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "pv")
    for _ in arrivals(views, "load", 3, path):
        run_each(counts, progress, table.upsert)
    return _ntz(table.current(), "window_start", "window_end")


def q_stream_uv_running(spark, sf, max_files=None, delay="0 seconds"):
    end = Ending(spark, at_once=not max_files)
    views = _views(spark, sf, end, max_files, delay, F.col("event_id").alias("seq"))
    return running_counts(run_to_table(stream_running_distinct(views, "ts", "user_id", "seq"), "stream_uv_running", end))


def q_stream_uv_hourly(spark, sf, max_files=None, delay="0 seconds"):
    end = Ending(spark, at_once=not max_files)
    out = run_to_table(stream_distinct_per_window(_views(spark, sf, end, max_files, delay), "ts", "user_id", "1 hour"), "stream_uv_hourly", end)
    return _ntz(out, "window_start", "window_end")


def _sides(spark, sf, close, max_files, delay):
    def side(etype, idn, tsn):
        ev = read_table_stream(spark, sf, "events", max_files).filter(F.col("event_type") == etype)
        return close(ev.select(F.col("user_id").alias("tx"), F.col("event_id").alias(idn), F.col("ts").alias(tsn)), tsn, delay)

    return side("purchase", "pay_id", "pay_ts"), side("signup", "receipt_id", "receipt_ts")


def q_stream_interval_join(spark, sf, max_files=None, delay="0 seconds"):
    pays, receipts = _sides(spark, sf, lambda df, ts, wait: df.withWatermark(ts, wait), max_files, delay)
    j = stream_interval_join(pays, receipts, "tx", "pay_ts", "receipt_ts", JOIN_LOWER, JOIN_UPPER)
    out = run_to_table(j.select("tx", "pay_id", "pay_ts", "receipt_id", "receipt_ts"), "stream_interval_join")
    return _ntz(out, "pay_ts", "receipt_ts")


def q_stream_reconcile(spark, sf, max_files=None, delay="0 seconds"):
    end = Ending(spark, at_once=not max_files)
    pays, receipts = _sides(spark, sf, end.close, max_files, delay)
    rows = stream_reconcile(pays, receipts, "tx", "pay_ts", "receipt_ts", "pay_id", "receipt_id", JOIN_LOWER, JOIN_UPPER)
    out = run_to_table(rows, "stream_reconcile", end)
    return out.select("tx", F.col("left_id").alias("pay_id"), _us("left_us", "pay_ts"), F.col("right_id").alias("receipt_id"), _us("right_us", "receipt_ts"), "status")


def q_stream_reconcile_one_to_one(spark, sf, max_files=None, delay="0 seconds"):
    end = Ending(spark, at_once=not max_files)
    kind = F.when(F.col("event_type") == "purchase", "pay").otherwise("receipt")
    ev = read_table_stream(spark, sf, "events", max_files).filter(F.col("event_type").isin("purchase", "signup"))
    both = end.close(ev.select(F.col("user_id").alias("tx"), "ts", F.col("event_id").alias("seq"), kind.alias("kind")), "ts", delay)
    out = run_to_table(P.stream_one_to_one(both, "tx", "ts", "seq", "kind", JOIN_LOWER, JOIN_UPPER), "stream_one_to_one", end)
    return out.select("tx", F.col("pay_seq").alias("pay_id"), _us("pay_us", "pay_ts"), F.col("receipt_seq").alias("receipt_id"),
                      _us("receipt_us", "receipt_ts"), "status")


def _orders(spark, sf, end, max_files, delay) -> DataFrame:
    orders = D.order_events(read_table_stream(spark, sf, "events", max_files))
    return end.close(orders.filter(F.col("event_type").isin("create", "pay")).select("order_id", "event_type", "ts", "seq"), "ts", delay)


def q_stream_order_status(spark, sf, max_files=None, delay="0 seconds"):
    end = Ending(spark, at_once=not max_files)
    rows = P.stream_order_status(_orders(spark, sf, end, max_files, delay), "order_id", "ts", "seq", "event_type", ORDER_WITHIN)
    out = run_to_table(rows, "stream_order_status", end)
    return out.select("order_id", _us("create_us", "create_ts"), _us("pay_us", "pay_ts"), "create_seq", "pay_seq", "status")


def _followed(spark, sf, max_files, delay) -> DataFrame:
    end = Ending(spark, at_once=not max_files)
    rows = P.stream_followed_by(_orders(spark, sf, end, max_files, delay), "order_id", "ts", "seq", "event_type", ORDER_WITHIN)
    return run_to_table(rows, "stream_followed_by", end)


def q_stream_order_paid(spark, sf, max_files=None, delay="0 seconds"):
    return _followed(spark, sf, max_files, delay).filter("status = 'match'").select(
        "order_id", _us("first_us", "first_ts"), "first_seq", _us("then_us", "then_ts"), "then_seq")


def q_stream_order_timeout(spark, sf, max_files=None, delay="0 seconds"):
    return _followed(spark, sf, max_files, delay).filter("status = 'timeout'").select(
        "order_id", _us("first_us", "first_ts"), "first_seq")


def _logins(spark, sf, end, max_files, delay) -> DataFrame:
    return end.close(D.logins(read_table_stream(spark, sf, "events", max_files)).select("user_id", "event_type", "ts", "seq"), "ts", delay)


def q_stream_fail_pairs(spark, sf, max_files=None, delay="0 seconds"):
    end = Ending(spark, at_once=not max_files)
    rows = P.stream_fail_pairs(_logins(spark, sf, end, max_files, delay), "user_id", "ts", "seq", "event_type", PAIR_GAP)
    return run_to_table(rows, "stream_fail_pairs", end).select(
        "user_id", _us("first_us", "first_ts"), _us("last_us", "last_ts"), "first_seq", "last_seq")


def q_stream_login_disorder(spark, sf):
    """Fail pairs of logins that come up to 5 s out of order, over several loads; time runs 600 times faster, so 2 hours are 12 s."""
    ensure_utc(spark)
    us = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / URL_FASTER)
    rows = D.logins(D.table(spark, sf, "events")).select("user_id", "event_type", us.alias("us"), "seq", (us + F.col("seq") % 6 * 1_000_000).alias("at"))
    low, high = rows.agg(F.min("at"), F.max("at")).first()
    period = ((high or 0) - (low or 0)) // URL_LOADS + 1
    rows = rows.select("user_id", "event_type", F.timestamp_micros("us").alias("ts"), "seq", F.floor((F.col("at") - F.lit(low or 0)) / period).cast("int").alias("load"))
    path, out, progress = (scratch_path(spark, f"disorder-{n}") for n in ("in", "out", "progress"))
    end = Ending(spark)
    rows.filter("load < 0").drop("load").write.parquet(path)
    stream = end.close(spark.readStream.schema("user_id long, event_type string, ts timestamp, seq long").parquet(path), "ts", "5 seconds")
    pairs = P.stream_fail_pairs(stream, "user_id", "ts", "seq", "event_type", "12 seconds")
    for _ in arrivals(rows, "load", URL_LOADS, path):
        run_to_table(pairs, "disorder", out=out, checkpoint=progress)
    found = run_to_table(pairs, "disorder", end, out=out, checkpoint=progress)
    return found.select("user_id", _us("first_us", "first_ts"), _us("last_us", "last_ts"), "first_seq", "last_seq")


def q_stream_fail_episodes(spark, sf, max_files=None, delay="0 seconds"):
    end = Ending(spark, at_once=not max_files)
    rows = P.stream_fail_episodes(_logins(spark, sf, end, max_files, delay), "user_id", "ts", "seq", "event_type", PAIR_GAP)
    return run_to_table(rows, "stream_fail_episodes", end).select(
        "user_id", _us("first_us", "first_ts"), _us("last_us", "last_ts"), "n_fails")


def q_stream_fail_runs(spark, sf, max_files=None, delay="0 seconds"):
    end = Ending(spark, at_once=not max_files)
    rows = P.stream_fail_runs(_logins(spark, sf, end, max_files, delay), "user_id", "ts", "seq", "event_type", RUN_N, RUN_WITHIN)
    return run_to_table(rows, "stream_fail_runs", end).select(
        "user_id", _us("first_us", "first_ts"), _us("last_us", "last_ts"), "first_seq", "last_seq", "n_events")


def _capped(spark, sf, max_files, delay) -> DataFrame:
    end = Ending(spark, at_once=not max_files)
    ev = read_table_stream(spark, sf, "events", max_files).select("user_id", "event_type", "ts", F.col("event_id").alias("seq"))
    rows = P.stream_click_cap(end.close(ev, "ts", delay), "user_id", "event_type", "ts", "seq", CAP)
    out = run_to_table(rows, "stream_click_cap", end)
    return out.select("user_id", "event_type", F.col("day").cast("date").alias("day"), _us("ts_us", "ts"), "seq", "status")


def q_stream_click_cap_pass(spark, sf, max_files=None, delay="0 seconds"):
    return _capped(spark, sf, max_files, delay).filter("status = 'pass'").select("user_id", "event_type", "ts", "seq", "day")


def q_stream_click_cap_warn(spark, sf, max_files=None, delay="0 seconds"):
    from pulsekit.operators.rules import BLACKLIST_WARNING
    return _capped(spark, sf, max_files, delay).filter("status = 'warn'").select(
        "user_id", "event_type", "day", "ts", "seq", F.lit(BLACKLIST_WARNING).alias("warning"))


# Same questions as the batch queries, so the same oracles.
STREAM_ORACLE_OF = {f"stream_{name}": name for name in (
    "pv_hourly", "hot_items_topn", "hot_urls_topn", "uv_hourly", "uv_running", "channel_counts",
    "ad_province_counts", "interval_join", "reconcile", "reconcile_one_to_one", "order_status", "order_paid",
    "order_timeout", "fail_pairs", "fail_episodes", "fail_runs", "click_cap_pass", "click_cap_warn")}
STREAM_QUERIES = {name: globals()[f"q_{name}"] for name in STREAM_ORACLE_OF}
# Questions of their own.
STREAM_ONLY = {"stream_hot_urls_late": q_stream_hot_urls_late, "stream_channel_ingest": q_stream_channel_ingest,
               "stream_pv_upsert": q_stream_pv_upsert, "stream_login_disorder": q_stream_login_disorder}
