"""Driver catalog: every operator run on the driver tables, with its DuckDB oracle.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame over the whole tables;
``ORACLES[name]`` is the same question in plain SQL over the registered views.
The mapping from the ``events`` table to the reference's record shapes is in
:mod:`pulsekit.sources.driver`.  The events are sparse (about 14 an hour at
sf0.01), so rules whose reference spans are seconds run here with spans of
hours; the window jobs keep the reference's sizes and slides.
"""

from __future__ import annotations

import functools
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.operators.joins import interval_join, reconcile
from pulsekit.operators.matching import reconcile_one_to_one
from pulsekit.operators.patterns import followed_by_tagged
from pulsekit.operators.rules import cap_per_day, cap_tagged
from pulsekit.operators.sketches import bitmap_partials, bitmap_window_counts
from pulsekit.operators.tagged import read_tagged, write_tagged
from pulsekit.plans import jobs
from pulsekit.session import ensure_utc, scratch_path
from pulsekit.functions.render import render_top_n
from pulsekit.sources import driver as D
from pulsekit.sources import readers as R
from pulsekit.sources.readers import parse_access_log, parse_lines, parse_tagged
from pulsekit.sources.schemas import RAW_USER_BEHAVIOR
from pulsekit.functions.time import seconds_to_ntz

H = 3_600_000_000  # one hour in µs

# Parameters of the driver runs (fixed here, shared by query and oracle).
TOP_N = 3
CAP = 3                      # daily click cap for the click-cap queries
PAIR_GAP = "2 hours"         # fail pairs / episodes interval
RUN_N, RUN_WITHIN = 3, "24 hours"
NEXT_N, NEXT_WITHIN = 2, "6 hours"
ORDER_WITHIN = "12 hours"
JOIN_LOWER, JOIN_UPPER = "-3 hours", "5 hours"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    ensure_utc(spark)
    return D.table(spark, sf, "events")


def _ub(spark, sf):
    return D.user_behavior(_events(spark, sf))


def q_hot_items_counts(spark, sf):
    return jobs.item_window_counts(_ub(spark, sf))


def q_hot_items_topn(spark, sf):
    return jobs.hot_items(_ub(spark, sf), TOP_N)


def _access_log(spark, sf):
    rows, _ = parse_access_log(D.access_log_lines(_events(spark, sf)))
    return rows


def q_log_parse(spark, sf):
    return _access_log(spark, sf).select("seq", "ip", "user_id", "ts", "method", "url")


def q_hot_urls_topn(spark, sf):
    return jobs.hot_urls(_access_log(spark, sf), TOP_N)


def q_csv_parse(spark, sf):
    rows, _ = parse_lines(D.user_behavior_lines(_events(spark, sf)), RAW_USER_BEHAVIOR)
    return rows.withColumn("ts", seconds_to_ntz("ts")).select(
        "seq", "user_id", "item_id", "category_id", "behavior", "ts")


def q_pv_hourly(spark, sf):
    return jobs.page_views(_ub(spark, sf))


def q_pv_salted(spark, sf):
    return jobs.page_views_salted(_ub(spark, sf), buckets=8)


def q_uv_hourly(spark, sf):
    return jobs.unique_visitors(_ub(spark, sf))


def _seven_digit_ids(spark, sf):
    """Views with ids of seven digits, of which some share their last six."""
    five = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / (5 * 60_000_000))
    return _ub(spark, sf).withColumn("user_id", F.col("user_id") + 1_000_000 * (1 + five % 9))


def q_uv_bitmap(spark, sf):
    """Ids of seven digits that share their last six, and so their offset; ``ids`` counts them exactly."""
    ub = _seven_digit_ids(spark, sf)
    exact = jobs.unique_visitors(ub).withColumnRenamed("uv", "ids")
    return jobs.unique_visitors_bitmap(ub).join(exact, ["window_start", "window_end"])


def q_uv_bitmap_sliding(spark, sf):
    """Hourly and sliding 24-hour counts from one stored table of hourly bitmaps; rows are read once."""
    views = _seven_digit_ids(spark, sf).filter(F.col("behavior") == "pv")
    path = scratch_path(spark, "bitmaps")
    bitmap_partials(views, "ts", "user_id").write.parquet(path)
    stored = spark.read.parquet(path)
    hours = [bitmap_window_counts(stored, "1 hour", n).withColumn("hours", F.lit(n)) for n in (1, 24)]
    return hours[0].unionByName(hours[1])


def q_uv_approx(spark, sf):
    """The exact count beside the sketch, and whether the sketch is within three standard errors (and one)."""
    ub = _ub(spark, sf)
    sketch = jobs.unique_visitors_approx(ub).withColumnRenamed("uv", "sketch")
    near = F.abs(F.col("sketch") - F.col("uv")) <= 1 + 0.03 * F.col("uv")
    return (jobs.unique_visitors(ub).join(sketch, ["window_start", "window_end"])
            .select("window_start", "window_end", "uv", near.alias("close")))


def q_uv_running(spark, sf):
    return jobs.unique_visitors_running(_ub(spark, sf))


def q_channel_counts(spark, sf):
    return jobs.channel_counts(D.market_behavior(_events(spark, sf)))


def _cap_input(spark, sf):
    return _events(spark, sf).select("user_id", "event_type", "ts", F.col("event_id").alias("seq"))


def q_click_cap_pass(spark, sf):
    passed, _ = cap_per_day(_cap_input(spark, sf), ["user_id", "event_type"], "ts", "seq", CAP)
    return passed


def q_click_cap_warn(spark, sf):
    _, warn = cap_per_day(_cap_input(spark, sf), ["user_id", "event_type"], "ts", "seq", CAP)
    return warn


def _in_one_pass(spark, tagged: DataFrame, name: str, *tags: str) -> DataFrame:
    """Each tag written to its own folder by one job, and read back."""
    path = scratch_path(spark, name)
    write_tagged(tagged, path)
    outputs = [read_tagged(spark, path, t).withColumn("status", F.lit(t)) for t in tags]
    return functools.reduce(DataFrame.unionByName, outputs)


def q_click_cap_tagged(spark, sf):
    tagged = cap_tagged(_cap_input(spark, sf), ["user_id", "event_type"], "ts", "seq", CAP)
    return _in_one_pass(spark, tagged, "click-cap", "pass", "warn")


def q_order_pattern_tagged(spark, sf):
    orders = _orders(spark, sf)
    tagged = followed_by_tagged(orders, "order_id", "ts", "seq", F.col("event_type") == "create", F.col("event_type") == "pay", ORDER_WITHIN)
    return _in_one_pass(spark, tagged, "order-pattern", "match", "timeout")


def q_csv_rejects_tagged(spark, sf):
    """Lines of which some lack a field or hold text where a number belongs."""
    lines = D.user_behavior_lines(_events(spark, sf))
    value = (F.when(F.col("seq") % 17 == 0, F.substring_index("value", ",", 3)).when(F.col("seq") % 19 == 0, F.concat(F.lit("x"), F.col("value")))
             .otherwise(F.col("value")))
    tagged = parse_tagged(lines.withColumn("value", value), RAW_USER_BEHAVIOR).withColumnRenamed("value", "line")
    return _in_one_pass(spark, tagged.withColumn("line", F.when(F.col("status") == "reject", F.col("line"))), "csv", "ok", "reject").drop("ts")


def q_ad_province_counts(spark, sf):
    """The cap needs no province: only clicks that pass are joined with the customers."""
    passed, _ = jobs.ad_click_cap(D.clicks(_events(spark, sf)), CAP)
    located = D.located(passed, D.table(spark, sf, "customer"), D.table(spark, sf, "nation"))
    return jobs.province_counts(located)


def _logins(spark, sf):
    return D.logins(_events(spark, sf))


def q_fail_pairs(spark, sf):
    return jobs.login_fail_pairs(_logins(spark, sf), PAIR_GAP)


def q_fail_pairs_arrival(spark, sf):
    """Arrival runs backwards within every seven rows, so it is not the order of event time."""
    q = F.col("seq")
    late = _logins(spark, sf).withColumn("seq", q - q % 7 + 6 - q % 7)
    return jobs.login_fail_pairs(late, PAIR_GAP, order="arrival")


def q_fail_episodes(spark, sf):
    return jobs.login_fail_episodes(_logins(spark, sf), PAIR_GAP)


def q_fail_runs(spark, sf):
    return jobs.login_fail_runs(_logins(spark, sf), RUN_N, RUN_WITHIN)


def q_fail_next(spark, sf):
    return jobs.login_fail_runs(_logins(spark, sf), NEXT_N, NEXT_WITHIN)


def _orders(spark, sf):
    return D.order_events(_events(spark, sf))


def q_order_paid(spark, sf):
    m, _ = jobs.order_pay_pattern(_orders(spark, sf), ORDER_WITHIN)
    return m


def q_order_timeout(spark, sf):
    _, t = jobs.order_pay_pattern(_orders(spark, sf), ORDER_WITHIN)
    return t


def q_order_status(spark, sf):
    return jobs.order_pay_state(_orders(spark, sf), ORDER_WITHIN)


def q_interval_join(spark, sf):
    ev = _events(spark, sf)
    return interval_join(D.pays(ev), D.receipts(ev), "tx", "pay_ts", "receipt_ts", JOIN_LOWER, JOIN_UPPER)


def q_reconcile(spark, sf):
    ev = _events(spark, sf)
    return reconcile(D.pays(ev), D.receipts(ev), "tx", "pay_ts", "receipt_ts", "pay_id", "receipt_id",
                     JOIN_LOWER, JOIN_UPPER)


def q_reconcile_one_to_one(spark, sf):
    ev = _events(spark, sf)
    return reconcile_one_to_one(D.pays(ev), D.receipts(ev), "tx", "pay_ts", "receipt_ts", "pay_id", "receipt_id", JOIN_LOWER, JOIN_UPPER)


def _read_back(spark, lines: DataFrame, read) -> DataFrame:
    """Lines written as text files and read by a reader of the library; every line must parse."""
    path = scratch_path(spark, "lines")
    lines.select("value").write.text(path)
    rows, rejects = read(spark, path)
    return rows.drop("seq").unionByName(rejects.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.drop("seq").schema.fields)))


def q_read_ad_clicks(spark, sf):
    return _read_back(spark, D.ad_click_lines(_events(spark, sf), D.table(spark, sf, "customer"), D.table(spark, sf, "nation")), R.read_ad_clicks)


def q_read_logins(spark, sf):
    return _read_back(spark, D.login_lines(_events(spark, sf)), R.read_logins)


def q_read_orders(spark, sf):
    return _read_back(spark, D.order_lines(_events(spark, sf)), R.read_orders)


def q_read_receipts(spark, sf):
    return _read_back(spark, D.receipt_lines(_events(spark, sf)), R.read_receipts)


def q_read_market(spark, sf):
    return _read_back(spark, D.market_lines(_events(spark, sf)), R.read_market)


def q_hot_items_text(spark, sf):
    """The ranked lists as the text that a console shows, one per window end."""
    return render_top_n(q_hot_items_topn(spark, sf), "window_end", "rank", "item_id", "cnt")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hot_items_counts": q_hot_items_counts,
    "hot_items_topn": q_hot_items_topn,
    "log_parse": q_log_parse,
    "hot_urls_topn": q_hot_urls_topn,
    "csv_parse": q_csv_parse,
    "pv_hourly": q_pv_hourly,
    "pv_salted": q_pv_salted,
    "uv_hourly": q_uv_hourly,
    "uv_bitmap": q_uv_bitmap,
    "uv_bitmap_sliding": q_uv_bitmap_sliding,
    "uv_approx": q_uv_approx,
    "uv_running": q_uv_running,
    "channel_counts": q_channel_counts,
    "click_cap_pass": q_click_cap_pass,
    "click_cap_warn": q_click_cap_warn,
    "click_cap_tagged": q_click_cap_tagged,
    "order_pattern_tagged": q_order_pattern_tagged,
    "csv_rejects_tagged": q_csv_rejects_tagged,
    "ad_province_counts": q_ad_province_counts,
    "fail_pairs": q_fail_pairs,
    "fail_pairs_arrival": q_fail_pairs_arrival,
    "fail_episodes": q_fail_episodes,
    "fail_runs": q_fail_runs,
    "fail_next": q_fail_next,
    "order_paid": q_order_paid,
    "order_timeout": q_order_timeout,
    "order_status": q_order_status,
    "interval_join": q_interval_join,
    "reconcile": q_reconcile,
    "reconcile_one_to_one": q_reconcile_one_to_one,
    "read_ad_clicks": q_read_ad_clicks,
    "read_logins": q_read_logins,
    "read_orders": q_read_orders,
    "read_receipts": q_read_receipts,
    "read_market": q_read_market,
    "hot_items_text": q_hot_items_text,
}

from pulsekit.plans.stream_catalog import STREAM_ONLY, STREAM_QUERIES  # noqa: E402

QUERIES.update(STREAM_QUERIES | STREAM_ONLY)
