"""Explicit schemas of the raw inputs (never inferred) and of the typed records."""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S = T.LongType(), T.IntegerType(), T.StringType()
NTZ = T.TimestampNTZType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw line layouts, field order as in the files (epoch seconds unless noted).
RAW_USER_BEHAVIOR = _st(("user_id", L), ("item_id", L), ("category_id", I), ("behavior", S), ("ts", L))
RAW_AD_CLICK = _st(("user_id", L), ("ad_id", L), ("province", S), ("city", S), ("ts", L))
RAW_LOGIN = _st(("user_id", L), ("ip", S), ("event_type", S), ("ts", L))
RAW_ORDER = _st(("order_id", L), ("event_type", S), ("tx_id", S), ("ts", L))
RAW_RECEIPT = _st(("tx_id", S), ("pay_channel", S), ("ts", L))
RAW_MARKET = _st(("user_id", L), ("behavior", S), ("channel", S), ("ts", L))  # ts in ms

# Typed records: event time as zone-less timestamp, plus an arrival sequence.
USER_BEHAVIOR = _st(("user_id", L), ("item_id", L), ("category_id", I), ("behavior", S), ("ts", NTZ))
ACCESS_LOG = _st(("ip", S), ("user_id", S), ("ts", NTZ), ("method", S), ("url", S))
AD_CLICK = _st(("user_id", L), ("ad_id", L), ("province", S), ("city", S), ("ts", NTZ))
LOGIN = _st(("user_id", L), ("ip", S), ("event_type", S), ("ts", NTZ))
ORDER = _st(("order_id", L), ("event_type", S), ("tx_id", S), ("ts", NTZ))
RECEIPT = _st(("tx_id", S), ("pay_channel", S), ("ts", NTZ))
MARKET = _st(("user_id", L), ("behavior", S), ("channel", S), ("ts", NTZ))
