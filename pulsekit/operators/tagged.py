"""Several outputs of one pass: a frame whose ``status`` says where each row goes.

Operators with side outputs return one tagged frame; :func:`write_tagged`
sends every tag to a folder of its own in a single job, whose commit shows
all of them or none, and :func:`read_tagged` reads one back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATUS = "status"


def write_tagged(df: DataFrame, path: str, tag: str = STATUS, mode: str = "error") -> None:
    """One job, one commit: rows of tag ``x`` to ``path/tag=x``.  Rows without a tag go to Spark's default partition."""
    df.write.mode(mode).partitionBy(tag).parquet(path)


def read_tagged(spark: SparkSession, path: str, value: str, columns: list[str] | None = None, tag: str = STATUS) -> DataFrame:
    """The rows of one tag, with ``columns`` (default: all but the tag); only that tag's files are read."""
    df = spark.read.parquet(path).filter(F.col(tag) == value)
    return df.select(*(columns or [c for c in df.columns if c != tag]))
