"""Optional text rendering of typed results.

The typed columns are the result; these helpers only reproduce the shape of
the reference's printed lines for people who want to read them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ts_text(c) -> Column:
    """``yyyy-MM-dd HH:mm:ss.S`` like ``java.sql.Timestamp.toString``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.S")


def render_top_n(df: DataFrame, window_end: str, rank: str, key: str, cnt: str,
                 key_label: str = "ItemId") -> DataFrame:
    """One text block per window end: a header line, then ``TopN key count`` lines.

    Built with a grouped ``array_sort`` over at most ``n`` rows per window end
    (the input is already a top-N result, so each group is bounded by ``n``).
    """
    line = F.format_string(f"Top%d {key_label}:%s Count:%d", F.col(rank), F.col(key).cast("string"), F.col(cnt))
    return (df.groupBy(window_end)
              .agg(F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), line.alias("l")))).alias("_ls"))
              .select(window_end,
                      F.concat_ws("\n", F.concat(F.lit("===="), ts_text(window_end), F.lit("====")),
                                  F.transform("_ls", lambda x: x["l"])).alias("text")))
