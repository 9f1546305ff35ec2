"""The running count of distinct ids per window, one output per row.

Every row of a window gets the number of ids seen in the window up to it, in
(time, seq) order.  Neither a frequent id nor a busy window is one task:

1. Of each (window, id) only the earliest row can be the first sighting.  Map
   tasks keep the earliest of theirs; a processor keyed by (window, salt of
   the id) decides between them, once the watermark has passed, by a bitmap
   of the ids seen, kept in pages (:class:`FirstSightings`).
2. Rows and first sightings meet by (window, slice of it).  When the watermark
   reaches the slice's end its rows get their count within the slice, in
   order, and the slice goes (:class:`SliceCounts`).
3. The reader adds what the window's earlier slices counted: a sum over a few
   slices a window (:func:`running_counts`).
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from pulsekit.functions.time import floor_div, micros_to, to_micros

#: Ids of a bitmap page: 1 KB.
PAGE_BITS = 8192


def _watermark_us(timer_values) -> int:
    return timer_values.getCurrentWatermarkInMs() * 1000


class _Held(StatefulProcessor):
    """Rows that wait for the watermark."""

    fields = ""

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.fields)

    def hold(self, rows: list[tuple]) -> None:
        for a in range(0, len(rows), 1000):
            self.rows.appendList(rows[a:a + 1000])

    def close(self) -> None:
        pass


class FirstSightings(_Held):
    """(us, seq) of the first row of each id in a window, for one salt of its ids.

    State: candidates ahead of the watermark and the bitmap pages of the ids
    seen; both go when the watermark reaches the window's end.  Candidates
    behind the watermark are not counted.
    """

    fields = "us long, seq long, id long"
    out = "q long, slice long, us long, seq long, sighting int"

    def __init__(self, size_us: int, slice_us: int):
        self.size, self.slice = size_us, slice_us

    def init(self, handle) -> None:
        super().init(handle)
        self.pages = handle.getMapState("pages", "page long", "bits binary")

    def handleInputRows(self, key, rows, timerValues):
        passed = _watermark_us(timerValues)
        ahead = [(r.us, r.seq, r.id) for r in rows if r.us >= passed]
        if ahead:
            self.hold(ahead)
            self.handle.registerTimer(min(us for us, _, _ in ahead) // 1000)
            self.handle.registerTimer((key[0] + 1) * self.size // 1000 - 1)
        return iter(())

    def _first(self, pages: dict, id_: int) -> bool:
        """Whether the id was not seen yet; now it is."""
        page, bit = divmod(id_, PAGE_BITS)
        if page not in pages:
            known = self.pages.getValue((page,)) if self.pages.containsKey((page,)) else None
            pages[page] = bytearray(known[0]) if known else bytearray(PAGE_BITS // 8)
        at, mask = bit >> 3, 1 << (bit & 7)
        new = not pages[page][at] & mask
        pages[page][at] |= mask
        return new

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed, due, rest = _watermark_us(timerValues), [], []
        for row in self.rows.get() if self.rows.exists() else ():
            (due if row[0] < passed else rest).append(tuple(row))
        pages: dict[int, bytearray] = {}
        for us, seq, id_ in sorted(due):
            if self._first(pages, id_):
                yield Row(q=key[0], slice=us // self.slice, us=us, seq=seq, sighting=1)
        if passed >= (key[0] + 1) * self.size:
            self.pages.clear()
            self.rows.clear()
            return
        for page, bits in pages.items():
            self.pages.updateValue((page,), (bytes(bits),))
        if due:
            self.rows.clear()
            self.hold(rest)
        if rest:
            self.handle.registerTimer(max(min(r[0] for r in rest), passed) // 1000)


class SliceCounts(_Held):
    """For each row of a slice, the first sightings in the slice up to it."""

    fields = "us long, seq long, sighting int"
    out = "q long, slice long, us long, seq long, seen long"

    def __init__(self, slice_us: int):
        self.slice = slice_us

    def handleInputRows(self, key, rows, timerValues):
        passed = _watermark_us(timerValues)
        end = (key[1] + 1) * self.slice
        if end <= passed:
            # first sightings come with the watermark that closes their slice; rows that come now are too late
            some = [(r.us, r.seq, r.sighting) for r in rows if r.sighting]
            if not some:
                return iter(())
        else:
            some = [(r.us, r.seq, r.sighting) for r in rows if r.sighting or r.sighting == 0 and r.us >= passed]
        if some:
            self.hold(some)
            self.handle.registerTimer(end // 1000 - 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        seen = 0
        for us, seq, no_row in sorted((us, seq, -sighting) for us, seq, sighting in (self.rows.get() if self.rows.exists() else ())):
            if no_row:
                seen += 1
            else:
                yield Row(q=key[0], slice=key[1], us=us, seq=seq, seen=seen)
        self.rows.clear()


def stream_running_distinct(df: DataFrame, ts: str, id_col: str, seq: str, size="1 hour", slice="5 minutes", salts: int = 32) -> DataFrame:
    """A watermarked stream → q (window number), slice, us, seq and ``seen`` (first sightings in the slice up to the row).

    ``id_col`` holds whole numbers; ids without one and rows without a time
    are left out.  Rows behind the watermark when they come are left out as
    well.  ``slice`` must divide ``size``.  Finish with :func:`running_counts`.
    """
    size_us, slice_us = to_micros(size), to_micros(slice)
    if size_us % slice_us or slice_us % 1000:
        raise ValueError("the slice must divide the size; it is whole milliseconds")
    us = F.unix_micros(ts)
    x = df.select(us.alias("us"), F.col(seq).cast("long").alias("seq"), F.col(id_col).cast("long").alias("id")).filter("us IS NOT NULL")
    x = x.select(floor_div(F.col("us"), size_us).alias("q"), floor_div(F.col("us"), slice_us).alias("slice"), "us", "seq", "id")

    def earliest(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t.filter(pc.is_valid(t.column("id"))).sort_by([("us", "ascending"), ("seq", "ascending")])
            got = t.group_by(["q", "id"], use_threads=False).aggregate([("us", "first"), ("seq", "first")])
            yield from got.rename_columns(["q", "id", "us", "seq"]).to_batches()

    some = (x.select("q", "us", "seq", "id").mapInArrow(earliest, "q long, id long, us long, seq long")
            .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")))
    first = some.groupBy("q", "salt").transformWithState(
        FirstSightings(size_us, slice_us), T.StructType.fromDDL(FirstSightings.out), "append", "EventTime")
    # no filter on the id: it would be pushed below the watermark, where the end of input has none
    rows = x.select("q", "slice", "us", "seq", F.when(F.col("id").isNotNull(), 0).alias("sighting"))
    return rows.unionByName(first).groupBy("q", "slice").transformWithState(
        SliceCounts(slice_us), T.StructType.fromDDL(SliceCounts.out), "append", "EventTime")


def running_counts(rows: DataFrame, seq: str = "seq", size="1 hour", name: str = "uv") -> DataFrame:
    """What :func:`stream_running_distinct` wrote → seq, window_start, window_end and the running count of the window."""
    size_us = to_micros(size)
    before = Window.partitionBy("q").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy("q", "slice").agg(F.max("seen").alias("all")).select(
        "q", "slice", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("earlier"))
    end = (F.col("q") + 1) * F.lit(size_us)
    ntz = T.TimestampNTZType()
    return rows.join(slices, ["q", "slice"]).select(
        F.col("seq").alias(seq), micros_to(end - F.lit(size_us), ntz).alias("window_start"), micros_to(end, ntz).alias("window_end"),
        (F.col("earlier") + F.col("seen")).alias(name))
