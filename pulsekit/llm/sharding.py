"""Resharding by minimum-cost flow, rewriting only the files that change.

A stored table's files belong to old shards; new shards have capacities in
bytes.  A flow network (old shards, new shards, a byte that stays costs
nothing, one that moves costs one) is solved exactly, so no plan moves fewer
bytes.  Its flows cut each old shard, laid out as blocks of consecutive rows
file by file, into the part that stays and the parts that go.  A block inside
one part goes as a whole; a block that a cut runs through is dealt row by
row, largest first, to the part with the most room left, so shard sizes miss
their capacities by about the smallest rows only.

Files whose rows all stay are kept as they are.  The others are read once and
their rows written to new files of their shards.  A manifest lists the files
of every shard with their first slot.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsekit.llm.common import PREFIX, text_bytes, written

_SHARD, _FILE, _BLOCK = PREFIX + "shard", PREFIX + "file", PREFIX + "block"


def min_cost_flow(supply: Sequence[int], capacity: Sequence[int], cost) -> dict[tuple[int, int], int]:
    """Flows (from, to) -> amount that ship all ``supply`` within ``capacity`` at least total ``cost(i, j)`` each.

    Successive shortest paths with labels corrected by Bellman-Ford rounds:
    the graph has one node per shard, however large the shards are.
    """
    if sum(supply) > sum(capacity):
        raise ValueError("capacities hold less than the shards")
    n, m = len(supply), len(capacity)
    flow: dict[tuple[int, int], int] = {}
    supply_left, room = list(supply), list(capacity)
    price = {(i, j): cost(i, j) for i in range(n) for j in range(m)}
    while any(supply_left):
        far = {("o", i): 0 for i in range(n) if supply_left[i]}
        via: dict = {}
        changed = True
        while changed:
            changed = False
            for (i, j), c in price.items():
                if ("o", i) in far and far["o", i] + c < far.get(("n", j), float("inf")):
                    far["n", j], via["n", j], changed = far["o", i] + c, ("o", i), True
                if flow.get((i, j)) and ("n", j) in far and far["n", j] - c < far.get(("o", i), float("inf")):
                    far["o", i], via["o", i], changed = far["n", j] - c, ("n", j), True
        end = min((("n", j) for j in range(m) if room[j]), key=lambda x: far[x])
        path = [end]
        while path[-1] in via:
            path.append(via[path[-1]])
        path.reverse()
        steps = list(zip(path, path[1:], strict=False))
        some = min([supply_left[path[0][1]], room[end[1]], *(flow[b[1], a[1]] for a, b in steps if a[0] == "n")])
        for a, b in steps:
            key = (a[1], b[1]) if a[0] == "o" else (b[1], a[1])
            flow[key] = flow.get(key, 0) + (some if a[0] == "o" else -some)
        supply_left[path[0][1]] -= some
        room[end[1]] -= some
    return {k: v for k, v in flow.items() if v}


def transfers(sizes: dict[int, int], capacities: Sequence[int]) -> list[tuple[int, int, int, int]]:
    """Cuts (old shard, new shard, from byte, to byte) of every old shard that move the fewest bytes; what stays comes first."""
    old = sorted(sizes)
    flow = min_cost_flow([sizes[i] for i in old], capacities, lambda i, j: int(old[i] != j))
    out = []
    for i, shard in enumerate(old):
        at = 0
        for j in sorted((j for a, j in flow if a == i), key=lambda j: (j != shard, j)):
            out.append((shard, j, at, at + flow[i, j]))
            at += flow[i, j]
    return out


def even_capacities(total: int, n: int) -> list[int]:
    return [total // n + (i < total % n) for i in range(n)]


def reshard(spark: SparkSession, path: str, out: str, n_shards: int, *, size: Column | None = None,
            old_shard: Column | None = None, text_col: str = "text", block_rows: int = 2048) -> DataFrame:
    """Deal the table at ``path`` into ``n_shards`` shards of near equal bytes, writing changed files under ``out``.

    ``size``: bytes of a row (default: UTF-8 bytes of ``text_col``, null:
    none, plus 1).  ``old_shard``: the shard that a file belongs to, from
    ``_metadata`` (default: the files dealt out by name over ``n_shards``).
    Returns the manifest, one row per file: shard, file, n_rows, first_slot,
    rewritten.  An empty table has an empty manifest.
    """
    size = size if size is not None else text_bytes(text_col) + 1
    old_shard = old_shard if old_shard is not None else F.pmod(F.crc32(F.col("_metadata.file_name").cast("binary")), F.lit(n_shards))
    table = spark.read.parquet(path)
    names = table.columns
    rows = table.select(*names, F.col("_metadata.file_path").alias(_FILE), size.cast("long").alias(PREFIX + "size"),
                        old_shard.cast("int").alias(PREFIX + "old"),
                        F.floor(F.col("_metadata.row_index") / block_rows).alias(_BLOCK))
    blocks = written(rows.groupBy(PREFIX + "old", _FILE, _BLOCK).agg(F.sum(PREFIX + "size").alias(PREFIX + "bytes")), "blocks")
    sizes = {r[0]: r[1] for r in blocks.groupBy(PREFIX + "old").agg(F.sum(PREFIX + "bytes")).collect()}
    cuts = spark.createDataFrame(transfers(sizes, even_capacities(sum(sizes.values()), n_shards)),
                                 f"{PREFIX}old int, {_SHARD} int, {PREFIX}a long, {PREFIX}b long")
    through = F.sum(PREFIX + "bytes").over(Window.partitionBy(PREFIX + "old").orderBy(_FILE, _BLOCK))
    laid = blocks.withColumn(PREFIX + "to", through)
    low = F.greatest(F.col(PREFIX + "to") - F.col(PREFIX + "bytes"), F.col(PREFIX + "a"))
    room = F.least(PREFIX + "to", PREFIX + "b") - low
    parts = (laid.join(F.broadcast(cuts), PREFIX + "old")  # old shards x new shards rows
             .filter(room > 0).groupBy(PREFIX + "old", _FILE, _BLOCK)
             .agg(F.sort_array(F.collect_list(F.struct(F.col(_SHARD), room.alias("room")))).alias(PREFIX + "parts")))
    moved = (F.size(PREFIX + "parts") > 1) | (F.col(PREFIX + "parts")[0][_SHARD] != F.col(PREFIX + "old"))
    changed = parts.groupBy(_FILE).agg(F.max(moved).alias(PREFIX + "changed"))
    plan = written(parts.join(changed, _FILE), "transfers")
    placed = rows.join(plan.filter(PREFIX + "changed").select(_FILE, _BLOCK, PREFIX + "parts"), [_FILE, _BLOCK])
    whole = placed.filter(F.size(PREFIX + "parts") == 1).select(F.col(PREFIX + "parts")[0][_SHARD].alias(_SHARD), *names)
    kept = [placed[c] for c in names]
    schema = placed.select(F.lit(0).alias(_SHARD), *kept).schema
    split = (placed.filter(F.size(PREFIX + "parts") > 1).groupBy(_FILE, _BLOCK)
             .applyInPandas(_dealt(names), schema))
    whole.unionByName(split).write.partitionBy(_SHARD).parquet(out)
    return _manifest(spark, table, out, plan)


def _dealt(names: list[str]):
    """Rows of one block, largest first, to the part with the most room left."""
    def run(block: pd.DataFrame) -> pd.DataFrame:
        room = [(-p["room"], p[_SHARD]) for p in block[PREFIX + "parts"].iloc[0]]
        heapq.heapify(room)
        block = block.sort_values(PREFIX + "size", ascending=False, kind="stable")
        to = []
        for n in block[PREFIX + "size"].tolist():
            left, shard = room[0]
            to.append(shard)
            heapq.heapreplace(room, (left + n, shard))
        out = block[names].copy()
        out.insert(0, _SHARD, to)
        return out

    return run


def _manifest(spark: SparkSession, table: DataFrame, out: str, plan: DataFrame) -> DataFrame:
    new = spark.read.schema(table.schema.add(_SHARD, "integer")).parquet(out)
    fresh = (new.select(F.col(_SHARD).alias("shard"), F.col("_metadata.file_path").alias("file"))
             .groupBy("shard", "file").count().withColumn("rewritten", F.lit(True)))
    stay = plan.filter(~F.col(PREFIX + "changed")).groupBy(F.col(_FILE).alias("file")).agg(F.max(PREFIX + "old").alias("shard"))
    same = (table.select(F.col("_metadata.file_path").alias("file")).groupBy("file").count().join(stay, "file")
            .withColumn("rewritten", F.lit(False)))
    files = fresh.unionByName(same).withColumnRenamed("count", "n_rows")
    before = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return written(files.withColumn("first_slot", F.coalesce(F.sum("n_rows").over(before), F.lit(0))), "manifest")


def read_shards(spark: SparkSession, path: str, out: str, manifest: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` of every row as now stored, with shard (int) and slot (long: its place in the shard, gapless from 0)."""
    old = spark.read.parquet(path)
    new = spark.read.schema(old.schema).option("recursiveFileLookup", "true").parquet(out)
    at = [F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(PREFIX + "row")]

    def part(t: DataFrame, rewritten: bool) -> DataFrame:
        files = manifest.filter(F.col("rewritten") == rewritten).select(
            F.col("file").alias(_FILE), F.col("shard").alias(_SHARD), F.col("first_slot").alias(PREFIX + "first"))
        return t.select(*columns, *at).join(files, _FILE).withColumn("shard", F.col(_SHARD)).withColumn(
            "slot", F.col(PREFIX + "first") + F.col(PREFIX + "row"))

    both = part(old, False).unionByName(part(new, True))
    return both.select(*(c for c in both.columns if not c.startswith(PREFIX)))
