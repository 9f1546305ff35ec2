"""Readers for the reference's line formats.

Every reader returns ``(rows, rejects)``: typed rows with an arrival ``seq``
column, and the lines that did not parse.  ``mode='FAILFAST'`` fails on the
first bad line instead, which is what the reference does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions.time import millis_to_ntz, parse_log_time, seconds_to_ntz
from pulsekit.sources import schemas as S  # noqa: F401


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines under ``path`` with ``seq``: files by name, then the place in the file.

    Spark packs large splits first, so row numbers of its partitions do not
    follow the files.  A line's number is its file's rank, then its split's
    byte offset plus its row in the split: a line has at least one byte, so
    this grows along a file of up to 2^40 bytes.  The table of splits is one
    row per split.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_f"),
                                       F.col("_metadata.file_block_start").alias("_b"),
                                       F.monotonically_increasing_id().alias("_m"))
    splits = raw.groupBy("_f", "_b").agg(F.min("_m").alias("_m0"))
    rank = F.dense_rank().over(Window.orderBy("_f")).cast("long") - 1
    place = splits.select("_f", "_b", (rank * (1 << 40) + F.col("_b") - F.col("_m0")).alias("_at"))
    return raw.join(place, ["_f", "_b"]).select("value", (F.col("_at") + F.col("_m")).alias("seq"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
             mode: str = "PERMISSIVE") -> tuple[DataFrame, DataFrame]:
    """Header-less delimited lines with an explicit schema; bad lines → rejects.

    Lines are split on ``sep`` without quoting rules, exactly as the
    reference's ``String.split`` does.  Empty string fields become NULL.
    ``mode='FAILFAST'`` raises on the first line that does not parse.
    """
    lines = _lines(spark, path)
    return parse_lines(lines, schema, sep=sep, mode=mode)


def parse_tagged(lines: DataFrame, schema: T.StructType, col: str = "value", sep: str = ",",
                 positions: list[int] | None = None, mode: str = "PERMISSIVE") -> DataFrame:
    """Lines in one pass: the fields where ``status`` is ``ok``, only the line where it is ``reject``."""
    keep, staged = _staged(lines, schema, col, sep, positions, mode)
    return staged.select(*keep, col, *(F.when(F.col("_ok"), F.col(n)).alias(n) for n in schema.names),
                         F.when(F.col("_ok"), "ok").otherwise("reject").alias("status"))


def parse_lines(lines: DataFrame, schema: T.StructType, col: str = "value", sep: str = ",",
                positions: list[int] | None = None, mode: str = "PERMISSIVE") -> tuple[DataFrame, DataFrame]:
    """Split text lines on ``sep`` and cast field ``positions[i]`` to ``schema[i]`` (P1, P2): rows and rejects.

    A line whose field is missing, or whose numeric field is empty or does not
    cast, is a reject (the reference's ``parseLong`` would throw).  Empty text
    fields (the create rows' tx id) become NULL.
    """
    keep, staged = _staged(lines, schema, col, sep, positions, mode)
    # Rows are selected through a generator, not a Filter: Catalyst would push
    # a Filter on ``_ok`` below these projections with every alias inlined,
    # re-evaluating the split (and whatever built the line) per field.
    rows = (staged.select(*keep, F.explode(F.when(F.col("_ok"), F.array(F.struct(*schema.names)))).alias("_x"))
            .select(*keep, "_x.*"))
    rejects = (staged.select(*keep, F.explode(F.when(~F.col("_ok"), F.array(F.col(col)))).alias(col)))
    return rows, rejects


def _staged(lines: DataFrame, schema: T.StructType, col: str, sep: str, positions: list[int] | None, mode: str) -> tuple[list[str], DataFrame]:
    """The other columns, and lines with their typed fields and whether they are good (``_ok``)."""
    positions = positions or list(range(len(schema.fields)))
    keep = [c for c in lines.columns if c != col]
    # Staged projections: split once, read each field once, cast once.  (A
    # single select would repeat the split, and the upstream expression of
    # the line, for every field reference.)
    parts = lines.select(*keep, col, F.split(F.col(col), _regex_quote(sep)).alias("_parts"))
    raw = parts.select(*keep, col, *[
        x for i, pos in enumerate(positions)
        for x in (F.nullif(F.get(F.col("_parts"), pos), F.lit("")).alias(f"_r{i}"),
                  F.get(F.col("_parts"), pos).isNotNull().alias(f"_h{i}"))])
    typed = raw.select(*keep, col, *[f"_h{i}" for i in range(len(positions))], *[
        (F.col(f"_r{i}") if isinstance(f.dataType, T.StringType)
         else F.col(f"_r{i}").try_cast(f.dataType)).alias(f.name)
        for i, f in enumerate(schema.fields)])
    ok = F.lit(True)
    for i, f in enumerate(schema.fields):
        ok = ok & F.col(f"_h{i}")
        if not isinstance(f.dataType, T.StringType):
            ok = ok & F.col(f.name).isNotNull()
    if mode.upper() == "FAILFAST":
        ok = F.coalesce(F.assert_true(ok, F.concat(F.lit("malformed line: "), F.col(col))).cast("boolean"),
                        F.lit(True))
    return keep, typed.select(*keep, col, F.coalesce(ok, F.lit(False)).alias("_ok"), *schema.names)


def _regex_quote(sep: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in sep)


def _typed(df: DataFrame, ts_fn, order: list[str]) -> DataFrame:
    return df.withColumn("ts", ts_fn("ts")).select(*order, "seq")


def read_user_behavior(spark, path, mode="PERMISSIVE"):
    """user_id, item_id, category_id, behavior, epoch seconds."""
    rows, bad = read_csv(spark, path, S.RAW_USER_BEHAVIOR, mode=mode)
    return _typed(rows, seconds_to_ntz, S.USER_BEHAVIOR.names), bad


def read_ad_clicks(spark, path, mode="PERMISSIVE"):
    """S3: user_id, ad_id, province, city, epoch seconds."""
    rows, bad = read_csv(spark, path, S.RAW_AD_CLICK, mode=mode)
    return _typed(rows, seconds_to_ntz, S.AD_CLICK.names), bad


def read_logins(spark, path, mode="PERMISSIVE"):
    """user_id, ip, event_type (success/fail), epoch seconds."""
    rows, bad = read_csv(spark, path, S.RAW_LOGIN, mode=mode)
    return _typed(rows, seconds_to_ntz, S.LOGIN.names), bad


def read_orders(spark, path, mode="PERMISSIVE"):
    """order_id, event_type (create/pay), tx_id (empty on create → NULL), epoch seconds."""
    rows, bad = read_csv(spark, path, S.RAW_ORDER, mode=mode)
    return _typed(rows, seconds_to_ntz, S.ORDER.names), bad


def read_receipts(spark, path, mode="PERMISSIVE"):
    """tx_id, pay_channel, epoch seconds."""
    rows, bad = read_csv(spark, path, S.RAW_RECEIPT, mode=mode)
    return _typed(rows, seconds_to_ntz, S.RECEIPT.names), bad


def read_market(spark, path, mode="PERMISSIVE"):
    """Marketing behaviour rows (user_id, behavior, channel, epoch ms)."""
    rows, bad = read_csv(spark, path, S.RAW_MARKET, mode=mode)
    return _typed(rows, millis_to_ntz, S.MARKET.names), bad


def parse_access_log(lines: DataFrame, col: str = "value", sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Fields 0 ip, 1 user, 3 time ``dd/MM/yyyy:HH:mm:ss``, 5 method, 6 url.

    Fields 2 and 4 (identity, zone offset) are not used.  ``sep`` defaults to
    the comma the reference splits on; web logs are usually space separated.
    """
    raw_schema = T.StructType([T.StructField(n, T.StringType(), True)
                               for n in ("ip", "user_id", "time_text", "method", "url")])
    keep = [c for c in lines.columns if c != col]
    # keep a copy of the line so rows whose time does not parse can be rejected whole
    rows, rejects = parse_lines(lines.withColumn("_line", F.col(col)), raw_schema, col=col, sep=sep,
                                positions=[0, 1, 3, 5, 6])
    rows = rows.withColumn("ts", parse_log_time("time_text"))
    bad_time = F.col("ts").isNull()
    good = rows.filter(~bad_time).select(*keep, "ip", "user_id", "ts", "method", "url")
    bad = rows.filter(bad_time).select(*keep, F.col("_line").alias(col))
    return good, rejects.select(*keep, col).unionByName(bad)


def read_access_log(spark: SparkSession, path: str, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    lines = _lines(spark, path)
    return parse_access_log(lines, sep=sep)
