"""Helpers shared by the corpus operators: written tables and column names."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.session import scratch_path

#: Columns that an operator adds for itself start so; callers' columns must not.
PREFIX = "__pk_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """``df`` as a table in the shared scratch folder, read back.

    Cuts the lineage: a lost executor costs the stages since the table, not
    those before it, and a table read twice is computed once.  ``free``: the
    shuffle files that made it go when it is there, not when the driver next
    happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_FREE, "false")
    if free:
        spark.conf.set(_FREE, "true")
    try:
        df.write.parquet(path)
    finally:
        if free:
            spark.conf.set(_FREE, before)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(col) -> F.Column:
    """UTF-8 bytes of a text, none for null."""
    return F.coalesce(F.octet_length(col), F.lit(0)).cast("long")


def sub_batches(texts: list, limit: int = 1 << 20):
    """``texts`` in runs of about ``limit`` characters, to bound the objects alive at once."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield texts[start:i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def pairwise_tree(items: list, combine):
    """Fold ``items`` with an associative ``combine`` in log2(n) rounds of neighbours."""
    while len(items) > 1:
        items = [combine(*p) if p[1] is not None else p[0]
                 for p in itertools.zip_longest(items[::2], items[1::2])]
    return items[0]
