"""Groups of rows brought together by a key, with groups of any size cut into tiles.

A group of more than ``tile`` rows is dealt by a hash into several parts, and
each pair of parts is a task's work of its own, so no task holds more than
about two parts however large the group is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deal_pairs(rows: DataFrame, sizes: DataFrame, key: list[str], by: str) -> DataFrame:
    """``rows`` of the groups in ``sizes`` (``key``, tiles), sorted by pair of parts.

    Adds t (the row's part) and a <= b (the pair); pairs of rows of one part
    meet where a = b, others where a < b.
    """
    mine = F.pmod(F.xxhash64(by), F.col("tiles")).cast("int")
    dealt = (rows.join(sizes, key).withColumn("t", mine).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .withColumn("a", F.least("t", "o")).withColumn("b", F.greatest("t", "o")).drop("o", "tiles"))
    return gathered(dealt, [*key, "a", "b"])


def gathered(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.repartition(*(F.col(c) for c in key)).sortWithinPartitions(*key)


def whole_groups(batches, key: list[str]):
    """Tables that hold whole groups of rows sorted by ``key``, each with the group's bounds."""
    held: list[pa.Table] = []
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if not t.num_rows:
            continue
        cuts = _bounds(t, key)
        if held and any(held[-1].column(c)[-1] != t.column(c)[0] for c in key):
            yield _with_bounds(held, key)
            held = []
        if len(cuts) > 2:
            yield _with_bounds([*held, t.slice(0, cuts[-2])], key)
            held, t = [], t.slice(cuts[-2])
        held.append(t)
    if held:
        yield _with_bounds(held, key)


def _with_bounds(tables: list[pa.Table], key: list[str]) -> tuple[pa.Table, np.ndarray]:
    t = pa.concat_tables(tables).combine_chunks()
    return t, _bounds(t, key)


def _bounds(t: pa.Table, key: list[str]) -> np.ndarray:
    change = np.zeros(t.num_rows, dtype=bool)
    change[:1] = True
    for c in key:
        v = t.column(c).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(change), t.num_rows)


def forest(near, n: int) -> list[tuple[int, int]]:
    """Spanning edges of a graph on 0..n-1, where ``near(x, left)`` gives the unreached neighbours of x."""
    left = np.ones(n, dtype=bool)
    out = []
    for root in range(n):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            x = queue.pop()
            reached = np.flatnonzero(near(x, left))
            left[reached] = False
            out += [(x, y) for y in reached.tolist()]
            queue += reached.tolist()
    return out
