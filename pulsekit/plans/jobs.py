"""The reference's jobs as batch DataFrame pipelines over typed inputs.

Inputs are the typed frames of :mod:`pulsekit.sources.readers` (or any frame
with the same columns, e.g. :mod:`pulsekit.sources.driver` views).  Each job
returns DataFrames; the caller decides where they go (``show``, parquet,
``foreachBatch``).  Streaming forms live in :mod:`pulsekit.streaming`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.keys import salt
from pulsekit.operators.distinct import (approx_distinct_per_window, bitmap_distinct_per_window,
                                         distinct_per_window, running_distinct)
from pulsekit.operators.joins import interval_join, reconcile
from pulsekit.operators.patterns import consecutive, followed_by
from pulsekit.operators.rules import cap_per_day, fail_episodes, fail_pairs, order_status
from pulsekit.operators.topn import top_n_by_count
from pulsekit.operators.windows import salted_counts, window_counts


# --- user behaviour: hot items, page views, unique visitors -----------------

def item_window_counts(ub: DataFrame, size="1 hour", slide="5 minutes") -> DataFrame:
    """Views per item and sliding window: item_id, window_start, window_end, cnt."""
    return window_counts(ub.filter(F.col("behavior") == "pv"), "ts", ["item_id"], size, slide)


def hot_items(ub: DataFrame, n: int = 3, size="1 hour", slide="5 minutes") -> DataFrame:
    """Top ``n`` items per window end: window_end, rank, item_id, cnt."""
    counts = item_window_counts(ub, size, slide)
    return top_n_by_count(counts, "window_end", "item_id", "cnt", n).select("window_end", "rank", "item_id", "cnt")


def page_views(ub: DataFrame, size="1 hour") -> DataFrame:
    """Views per tumbling window: window_start, window_end, pv."""
    return window_counts(ub.filter(F.col("behavior") == "pv"), "ts", None, size, name="pv")


def page_views_salted(ub: DataFrame, size="1 hour", buckets: int = 8, salt_cols=("seq",)) -> DataFrame:
    """Same numbers as :func:`page_views`, counted per salt first, then merged per window."""
    pv = ub.filter(F.col("behavior") == "pv")
    return salted_counts(pv, "ts", size, salt(list(salt_cols), buckets), buckets, name="pv")


def unique_visitors(ub: DataFrame, size="1 hour") -> DataFrame:
    return distinct_per_window(ub.filter(F.col("behavior") == "pv"), "ts", "user_id", size)


def unique_visitors_bitmap(ub: DataFrame, size="1 hour") -> DataFrame:
    return bitmap_distinct_per_window(ub.filter(F.col("behavior") == "pv"), "ts", "user_id", size)


def unique_visitors_approx(ub: DataFrame, size="1 hour", rsd: float = 0.01) -> DataFrame:
    return approx_distinct_per_window(ub.filter(F.col("behavior") == "pv"), "ts", "user_id", size, rsd=rsd)


def unique_visitors_running(ub: DataFrame, size="1 hour") -> DataFrame:
    """Per view row: seq, window_start, window_end, uv so far in its window."""
    return running_distinct(ub.filter(F.col("behavior") == "pv"), "ts", "user_id", "seq", size)


# --- network flow: hot urls ---------------------------------------------------

def url_window_counts(log: DataFrame, size="10 minutes", slide="5 minutes") -> DataFrame:
    """GET requests per url and sliding window (late rows count: batch sees them all)."""
    return window_counts(log.filter(F.col("method") == "GET"), "ts", ["url"], size, slide)


def hot_urls(log: DataFrame, n: int = 3, size="10 minutes", slide="5 minutes") -> DataFrame:
    """Top ``n`` GET urls per window end: window_end, rank, url, cnt (one current count per url)."""
    counts = url_window_counts(log, size, slide)
    return top_n_by_count(counts, "window_end", "url", "cnt", n).select("window_end", "rank", "url", "cnt")


# --- market: channels, ad clicks ---------------------------------------------

def channel_counts(market: DataFrame, size="1 hour", slide="5 seconds") -> DataFrame:
    """Rows per (channel, behavior) and sliding window."""
    return window_counts(market, "ts", ["channel", "behavior"], size, slide)


def ad_click_cap(clicks: DataFrame, max_clicks: int = 100, zone: str = "Asia/Shanghai"):
    """(passed clicks, blacklist warnings) with the per (user, ad, local day) cap."""
    return cap_per_day(clicks, ["user_id", "ad_id"], "ts", "seq", max_clicks, zone)


def ad_clicks_by_province(clicks: DataFrame, max_clicks: int = 100, size="1 hour", slide="5 seconds",
                          zone: str = "Asia/Shanghai") -> DataFrame:
    """Passed clicks per province and sliding window."""
    passed, _ = ad_click_cap(clicks, max_clicks, zone)
    return province_counts(passed, size, slide)


def province_counts(passed: DataFrame, size="1 hour", slide="5 seconds") -> DataFrame:
    """Clicks that passed the cap, per province and sliding window."""
    return window_counts(passed, "ts", ["province"], size, slide)


# --- login fail ----------------------------------------------------------------

def _fail(df: DataFrame):
    return F.col("event_type") == "fail"


def login_fail_episodes(logins: DataFrame, interval="2 seconds", grace="0 seconds") -> DataFrame:
    return fail_episodes(logins, "user_id", "ts", "seq", _fail(logins), interval, grace)


def login_fail_pairs(logins: DataFrame, interval="2 seconds", order: str = "event") -> DataFrame:
    return fail_pairs(logins, "user_id", "ts", "seq", _fail(logins), interval, order)


def login_fail_runs(logins: DataFrame, n: int = 5, within="5 seconds") -> DataFrame:
    return consecutive(logins, "user_id", "ts", "seq", _fail(logins), n, within)


# --- order pay -------------------------------------------------------------------

def order_pay_pattern(orders: DataFrame, within="15 minutes"):
    """(paid matches, timed-out creates) of create followed-by pay."""
    return followed_by(orders, "order_id", "ts", "seq", F.col("event_type") == "create",
                       F.col("event_type") == "pay", within)


def order_pay_state(orders: DataFrame, within="15 minutes") -> DataFrame:
    return order_status(orders, "order_id", "ts", "seq", F.col("event_type") == "create",
                        F.col("event_type") == "pay", within)


def _pay_side(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("event_type") == "pay").select(
        F.col("tx_id").alias("tx"), F.col("order_id"), F.col("seq").alias("pay_seq"), F.col("ts").alias("pay_ts"))


def _receipt_side(receipts: DataFrame) -> DataFrame:
    return receipts.select(F.col("tx_id").alias("tx"), F.col("pay_channel"),
                           F.col("seq").alias("receipt_seq"), F.col("ts").alias("receipt_ts"))


def pay_receipt_join(orders: DataFrame, receipts: DataFrame, lower="-3 seconds", upper="5 seconds") -> DataFrame:
    return interval_join(_pay_side(orders), _receipt_side(receipts), "tx", "pay_ts", "receipt_ts", lower, upper)


def pay_receipt_reconcile(orders: DataFrame, receipts: DataFrame, lower="-3 seconds",
                          upper="5 seconds") -> DataFrame:
    return reconcile(_pay_side(orders), _receipt_side(receipts), "tx", "pay_ts", "receipt_ts",
                     "pay_seq", "receipt_seq", lower, upper)
