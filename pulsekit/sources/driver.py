"""Views of the driver tables in the shapes the reference's jobs read.

``events`` (event_id, ts, user_id, event_type, value, props ``{"k": n}``) is
the behaviour stream; ``event_id`` is its arrival order.  Each function is a
projection (plus one join for provinces), so Catalyst prunes the scan to the
columns a query uses and pushes its filters into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.functions.time import ACCESS_LOG_TIME_FORMAT

# The four marketing channels and the behaviour names.
CHANNELS = ["app store", "wechat", "weibo", "tieba"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def item_id() -> Column:
    """The item number carried in ``props``."""
    return F.get_json_object("props", "$.k").cast("bigint")


def user_behavior(events: DataFrame) -> DataFrame:
    """S1 shape: view → pv, purchase → buy, click → cart, signup → fav, error → error."""
    behavior = (F.when(F.col("event_type") == "view", "pv")
                .when(F.col("event_type") == "purchase", "buy")
                .when(F.col("event_type") == "click", "cart")
                .when(F.col("event_type") == "signup", "fav")
                .otherwise(F.col("event_type")))
    return events.select(
        "user_id", item_id().alias("item_id"),
        F.pmod(item_id(), F.lit(10)).cast("int").alias("category_id"),
        behavior.alias("behavior"), "ts", F.col("event_id").alias("seq"))


def access_log_lines(events: DataFrame, sep: str = ",") -> DataFrame:
    """S2 text lines built from events: ip, user, -, time, zone, method, url.

    click and view are GETs of ``/item/<k>``; purchase and signup POSTs;
    error a PUT.  The line is what a web server would have written; the
    hot-URL job parses it back.
    """
    method = (F.when(F.col("event_type").isin("click", "view"), "GET")
              .when(F.col("event_type").isin("purchase", "signup"), "POST")
              .otherwise("PUT"))
    uid = F.col("user_id")
    ip = F.format_string("10.%d.%d.%d", F.pmod(F.floor(uid / 65536), F.lit(256)),
                         F.pmod(F.floor(uid / 256), F.lit(256)), F.pmod(uid, F.lit(256)))
    line = F.concat_ws(sep, ip, F.col("user_id").cast("string"), F.lit("-"),
                       F.date_format("ts", ACCESS_LOG_TIME_FORMAT), F.lit("+0000"), method,
                       F.concat(F.lit("/item/"), item_id().cast("string")))
    return events.select(F.col("event_id").alias("seq"), line.alias("value"))


def user_behavior_lines(events: DataFrame) -> DataFrame:
    """S1 CSV lines (epoch seconds) built from events."""
    ub = user_behavior(events)
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in ("user_id", "item_id", "category_id", "behavior")],
                       F.expr("CAST(timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS STRING)"))
    return ub.select("seq", line.alias("value"))


def _epoch(unit: str) -> Column:
    return F.expr(f"CAST(timestampdiff({unit}, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS STRING)")


def _csv(rows: DataFrame, *columns: str, unit: str = "SECOND") -> DataFrame:
    """Text lines of some columns (null: empty) and the time, with the arrival number."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return rows.select("seq", F.concat_ws(",", *fields, _epoch(unit)).alias("value"))


def ad_click_lines(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """S3 CSV lines: user, ad, province, city, epoch seconds."""
    return _csv(ad_clicks(events, customer, nation), "user_id", "ad_id", "province", "city")


def login_lines(events: DataFrame) -> DataFrame:
    """S4 CSV lines: user, ip, event type, epoch seconds."""
    return _csv(logins(events), "user_id", "ip", "event_type")


def order_lines(events: DataFrame) -> DataFrame:
    """S5 CSV lines: order, event type, transaction (empty on create), epoch seconds."""
    return _csv(order_events(events).filter(F.col("event_type").isin("create", "pay")), "order_id", "event_type", "tx_id")


def receipt_lines(events: DataFrame) -> DataFrame:
    """S6 CSV lines of signups as receipts: transaction, pay channel, epoch seconds."""
    channel = F.element_at(F.array(F.lit("wechat"), F.lit("alipay")), (F.pmod(item_id(), F.lit(2)) + 1).cast("int"))
    rows = events.filter(F.col("event_type") == "signup").select(
        F.concat(F.lit("tx"), F.col("user_id").cast("string")).alias("tx_id"), channel.alias("pay_channel"), "ts", F.col("event_id").alias("seq"))
    return _csv(rows, "tx_id", "pay_channel")


def market_lines(events: DataFrame) -> DataFrame:
    """S7 CSV lines: user, behaviour, channel, epoch milliseconds."""
    return _csv(market_behavior(events), "user_id", "behavior", "channel", unit="MILLISECOND")


def logins(events: DataFrame) -> DataFrame:
    """S4 shape: error → fail, anything else → success."""
    return events.select(
        "user_id", F.concat(F.lit("10.0.0."), F.pmod("user_id", F.lit(256)).cast("string")).alias("ip"),
        F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("event_type"),
        "ts", F.col("event_id").alias("seq"))


def order_events(events: DataFrame) -> DataFrame:
    """S5 shape keyed by user: signup → create, purchase → pay (tx = user id); other rows kept as-is."""
    etype = (F.when(F.col("event_type") == "signup", "create")
             .when(F.col("event_type") == "purchase", "pay")
             .otherwise(F.col("event_type")))
    tx = F.when(F.col("event_type") == "purchase", F.concat(F.lit("tx"), F.col("user_id").cast("string")))
    return events.select(F.col("user_id").alias("order_id"), etype.alias("event_type"), tx.alias("tx_id"),
                         "ts", F.col("event_id").alias("seq"))


def pays(events: DataFrame) -> DataFrame:
    """Pay side of the reconciliation: purchases keyed by user."""
    return (events.filter(F.col("event_type") == "purchase")
            .select(F.col("user_id").alias("tx"), F.col("event_id").alias("pay_id"), F.col("ts").alias("pay_ts")))


def receipts(events: DataFrame) -> DataFrame:
    """Receipt side of the reconciliation: signups keyed by user."""
    return (events.filter(F.col("event_type") == "signup")
            .select(F.col("user_id").alias("tx"), F.col("event_id").alias("receipt_id"),
                    F.col("ts").alias("receipt_ts")))


def clicks(events: DataFrame) -> DataFrame:
    """S3 shape without the place: clicks, ad = item."""
    return events.filter(F.col("event_type") == "click").select(
        "user_id", item_id().alias("ad_id"), "ts", F.col("event_id").alias("seq"))


def located(rows: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Click rows with province (nation of the customer whose key is the user) and city.

    ``nation`` is a fixed 25-row dimension, so it is broadcast.  ``customer``
    grows with the data: the join is left to the planner, whose broadcast
    threshold checks its size (AQE switches to a broadcast only under it).
    """
    geo = (customer.select("c_custkey", "c_nationkey", "c_mktsegment")
           .join(F.broadcast(nation.select("n_nationkey", "n_name")),
                 F.col("c_nationkey") == F.col("n_nationkey"))
           .select(F.col("c_custkey"), F.col("n_name").alias("province"), F.col("c_mktsegment").alias("city")))
    return rows.join(geo, rows.user_id == geo.c_custkey, "left").drop("c_custkey")


def ad_clicks(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """S3 shape: clicks, ad = item, province and city of the customer."""
    return located(clicks(events), customer, nation).select("user_id", "ad_id", "province", "city", "ts", "seq")


def market_behavior(events: DataFrame) -> DataFrame:
    """S7 shape: behaviour = upper-case event type, channel chosen by item number."""
    ch = F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), (F.pmod(item_id(), F.lit(4)) + 1).cast("int"))
    return events.select("user_id", F.upper("event_type").alias("behavior"), ch.alias("channel"), "ts",
                         F.col("event_id").alias("seq"))
