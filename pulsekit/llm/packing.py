"""Best-fit packing of token runs into sequences of a fixed capacity.

Bulk-synchronous best-fit decreasing.  Documents are range-sorted by length;
every document then has a rank among those of its length, found from the
sorted ranges without bringing a length's documents together.  Documents of
one length are interchangeable and so are gaps of one size, so a round works
on runs (length, first rank, count): at most ``capacity`` runs of documents
and a run of sequences per gap, however many rows there are.

A round sweeps the sizes downwards.  Gaps met are stacked, so the top of the
stack is the successor of the size at hand, the smallest gap that holds it;
documents take it by rank, a gap takes one document a round, those that lose
go on to the next gap or the next round.  Then gaps are updated and the sweep
repeats.  Lengths enter by halves of the capacity, longest first; when a
sweep places nothing, the longest of those left open as many sequences as
their tokens need at least.

Placing is a join of each row's (length, rank) with the rounds' runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.llm.common import PREFIX, written
from pulsekit.llm.library_ids import library_ids


def document_ids(text: Column, tokenizer: str, end_id: int) -> Column:
    """``binary``: little-endian unsigned 32-bit ids of a whole text (null: empty), closed by ``end_id``."""
    @F.arrow_udf("binary")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for found, at in library_ids(tokenizer, texts, end_id):
                offsets = pa.py_buffer((at * 4).astype(np.int32))
                yield pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, offsets, pa.py_buffer(found)])

    return ids(text)


def cut_pieces(docs: DataFrame, ids: str, capacity: int) -> DataFrame:
    """One row per piece of at most ``capacity`` ids, in place of ``ids``: piece, start, length, and its own ``ids``."""
    n = (F.octet_length(ids) / 4).cast("long")
    last = F.greatest(F.ceil(n / capacity) - 1, F.lit(0))
    pieces = docs.withColumn("piece", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    start = F.col("piece").cast("long") * capacity
    return (pieces.withColumn("start", start).withColumn("length", F.least(F.lit(capacity), n - start))
            .withColumn(ids, F.expr(f"substring({ids}, piece * {4 * capacity} + 1, {4 * capacity})")))


class _Sequences:
    """Open sequences by gap, and the placements made so far, all as runs."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = [counts.get(s, 0) for s in range(capacity + 1)]
        self.rank = [0] * (capacity + 1)
        self.gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.opened = 0
        self.placed: list[tuple[int, int, int, int, int]] = []

    def _place(self, size: int, count: int, sequence: int, gap: int) -> None:
        self.placed.append((size, self.rank[size], count, sequence, self.capacity - gap))
        self.rank[size] += count
        self.left[size] -= count

    def open(self, size: int, count: int) -> None:
        self._place(size, count, self.opened, self.capacity)
        self.gaps[self.capacity - size].append((self.opened, count))
        self.opened += count

    def sweep(self, low: int, high: int) -> bool:
        """One round for documents of ``low`` to ``high`` tokens; whether it placed any."""
        stack: list[tuple[int, int, int]] = []
        updated: list[tuple[int, int, int]] = []
        for size in range(self.capacity - 1, low - 1, -1):
            stack += [(size, *run) for run in self.gaps[size]]
            self.gaps[size] = []
            while size <= high and self.left[size] and stack:
                gap, sequence, count = stack.pop()
                some = min(count, self.left[size])
                self._place(size, some, sequence, gap)
                updated.append((gap - size, sequence, some))
                if some < count:
                    stack.append((gap, sequence + some, count - some))
        for gap, *run in stack + updated:
            self.gaps[gap].append(tuple(run))
        return bool(updated)

    def fill(self, low: int, high: int) -> None:
        while any(self.left[low:high + 1]):
            if self.sweep(low, high):
                continue
            tokens = sum(s * self.left[s] for s in range(low, high + 1))
            new = max(1, tokens // self.capacity)
            for size in range(high, low - 1, -1):
                if new and self.left[size]:
                    some = min(new, self.left[size])
                    self.open(size, some)
                    new -= some


def best_fit_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, offset) that place ``counts[length]`` documents of each length.

    The document of rank ``first rank + i`` goes to sequence ``first sequence
    + i``.  At most ``capacity`` lengths go in; what comes out is bounded by
    lengths and rounds, not by documents.
    """
    state = _Sequences(counts, capacity)
    full = state.left[capacity]
    if full:
        state.open(capacity, full)
    for size in range(capacity - 1, capacity // 2, -1):
        if state.left[size]:
            state.open(size, state.left[size])
    high = capacity // 2
    while high:
        state.fill(high // 2 + 1, high)
        high //= 2
    return state.placed


def pack(pieces: DataFrame, capacity: int, *, length: str = "length", order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (both long): best-fit into sequences of ``capacity``.

    Lengths from 1 to ``capacity`` are packed; a row whose length is null or
    outside gets null in both.  ``order`` breaks ties, so equal rows may swap
    places.  Columns of the two names are replaced; the rest are carried.
    """
    spark = pieces.sparkSession
    pos, part, rank = PREFIX + "pos", PREFIX + "part", PREFIX + "rank"
    by = [F.col(length).desc_nulls_last(), *(F.col(c) for c in order)]
    source = written(pieces.drop("sequence_id", "offset"), "pieces")  # the bounds of ranges are sampled: made once, read twice
    ranged = written(
        source.repartitionByRange(*by).sortWithinPartitions(*by)
        .withColumn(pos, F.monotonically_increasing_id()).withColumn(part, F.shiftright(pos, 33)), "packing")
    fits = F.col(length).between(1, capacity)
    runs = ranged.filter(fits).groupBy(part, length).agg(F.min(pos).alias(PREFIX + "first"), F.count("*").alias(PREFIX + "n"))
    counts = {r[0]: r[1] for r in runs.groupBy(length).agg(F.sum(PREFIX + "n")).collect()}
    earlier = Window.partitionBy(length).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    ahead = runs.select(part, length, (F.coalesce(F.sum(PREFIX + "n").over(earlier), F.lit(0)) - F.col(PREFIX + "first")).alias(rank))
    plan = spark.createDataFrame(best_fit_runs(counts, capacity),
                                 f"{PREFIX}size long, {PREFIX}from long, {PREFIX}count long, {PREFIX}sequence long, offset long")
    place = F.col(rank) - F.col(PREFIX + "from")
    ranked = ranged.join(ahead, [part, length], "left").withColumn(rank, F.col(rank) + F.col(pos))
    match = (F.col(length) == F.col(PREFIX + "size")) & (place >= 0) & (place < F.col(PREFIX + "count"))
    return (ranked.join(F.broadcast(plan), match, "left")  # bounded by capacity and rounds
            .withColumn("sequence_id", F.col(PREFIX + "sequence") + place)
            .select(*(c for c in ranged.columns if not c.startswith(PREFIX)), "sequence_id", "offset"))
