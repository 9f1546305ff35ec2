"""Connected components of a graph given as edges, in logarithmically many rounds.

Large-star and small-star rounds (Kiveris et al., 2014): every node links
its larger neighbours, then its smaller ones, to the smallest it knows.  The
edges become stars around the smallest node of each component.  A node with
very many neighbours is never gathered: its smallest neighbour is an
aggregate, combined before the shuffle, joined back on its edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One round.  ``edges``: u > v, distinct."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(low, "u")
    if large:
        new = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
    return new.filter(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long), component its smallest reachable node.

    Loops, repeated edges and either direction are fine.  Each round is
    written to the shared scratch folder; rounds end when the stars no longer
    change, which is known by the count and a checksum of the edges.
    """
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .filter(F.col("u") != F.col("v")).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        now = written(_stars(_stars(now, True), False), "edges")
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
