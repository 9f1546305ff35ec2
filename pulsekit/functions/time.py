"""Time helpers: epoch conversions, interval parsing, local days.

Batch tables carry zone-less ``timestamp_ntz`` event times; streams carry
``timestamp`` (watermarks need it).  Both are mapped to epoch microseconds with
expressions that do not depend on the session time zone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

_UNITS = {
    "us": 1, "microsecond": 1, "microseconds": 1,
    "ms": 1_000, "millisecond": 1_000, "milliseconds": 1_000,
    "s": 1_000_000, "sec": 1_000_000, "second": 1_000_000, "seconds": 1_000_000,
    "m": 60_000_000, "min": 60_000_000, "minute": 60_000_000, "minutes": 60_000_000,
    "h": 3_600_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
    "d": 86_400_000_000, "day": 86_400_000_000, "days": 86_400_000_000,
}


def to_micros(span) -> int:
    """'1 hour', '5 minutes', '900 seconds', 300 (seconds) → microseconds."""
    if isinstance(span, (int, float)):
        return int(span * 1_000_000)
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]+)\s*", str(span))
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"cannot read interval {span!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_micros(c) -> Column:
    """Epoch microseconds of a timestamp_ntz (zone independent)."""
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, {_sql(c)})")


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name")


def micros(df: DataFrame, ts: str) -> Column:
    """Epoch microseconds of column ``ts`` whatever its timestamp flavour."""
    dt = df.schema[ts].dataType
    if isinstance(dt, T.TimestampNTZType):
        return ntz_micros(ts)
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(F.col(ts))
    if isinstance(dt, T.DateType):
        return ntz_micros_expr(f"CAST(`{ts}` AS TIMESTAMP_NTZ)")
    raise TypeError(f"{ts} is {dt}, not a timestamp")


def ntz_micros_expr(sql: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, {sql})")


def micros_to(us: Column, like: T.DataType) -> Column:
    """Inverse of :func:`micros`, returning the same timestamp flavour as ``like``."""
    if isinstance(like, T.TimestampType):
        return F.timestamp_micros(us)
    return F.timestamp_add("MICROSECOND", us, F.expr(EPOCH_NTZ))


def floor_div(x: Column, n: int) -> Column:
    """Floor division by a positive constant, exact for negative values too."""
    # x - pmod(x, n) is an exact multiple of n, so the quotient is exact
    # for |x| < 2**53 (epoch microseconds stay far below that).
    return ((x - F.pmod(x, F.lit(n))) / F.lit(n)).cast("long")


def seconds_to_ntz(c) -> Column:
    """Epoch seconds (bigint) → timestamp_ntz (the reference's ``ts * 1000L``)."""
    return F.timestamp_add("SECOND", _col(c).cast("long"), F.expr(EPOCH_NTZ))


def millis_to_ntz(c) -> Column:
    """Epoch milliseconds → timestamp_ntz."""
    return F.timestamp_add("MILLISECOND", _col(c).cast("long"), F.expr(EPOCH_NTZ))


def ntz_to_seconds(c) -> Column:
    return F.expr(f"timestampdiff(SECOND, {EPOCH_NTZ}, {_sql(c)})")


# The access-log time layout read by the hot-URL job, to write and to read.
ACCESS_LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"
ACCESS_LOG_TIME = r"^(\d{2})/(\d{2})/(\d{4}):(\d{2}):(\d{2}):(\d{2})$"


def parse_log_time(c) -> Column:
    """Parse log time text to timestamp_ntz; unparsable text gives NULL.

    The zone-offset field of the log line is ignored, as in the reference: the
    text is a wall-clock time.  No session zone takes part, so times that some
    zone skips or repeats are read like any other.
    """
    day, month, year, hour, minute, second = (F.regexp_extract(_col(c), ACCESS_LOG_TIME, i).try_cast("int") for i in range(1, 7))
    return F.try_make_timestamp_ntz(year, month, day, hour, minute, second.cast("decimal(16,6)"))


def local_day(ts: str, zone: str = "Asia/Shanghai") -> Column:
    """Calendar day of a zone-less UTC instant as seen in ``zone``."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(ts)))
