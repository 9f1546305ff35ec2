"""Sliding window counts on a stream as runs of equal counts (W1-W4, with 720 windows a row).

A window's count changes only where a pane comes in or, ``size / slide``
panes later, goes out.  The processor keeps a key's live panes and gives
runs: from window ``first`` to window ``last`` the count was ``cnt``.  That is
at most two rows a pane and one each time the watermark moves, whatever the
overlap; readers make windows of them (:func:`windows_of`).

Rows are counted per (key, pane) inside the map tasks before the shuffle.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from pulsekit.functions.time import floor_div, micros_to, to_micros


class PaneRuns(StatefulProcessor):
    """Runs of one key.  State: panes that still count or are ahead, and the first window not given yet.

    A window is known by its last pane.  It is given once the watermark is
    past that pane; rows of a pane whose window was given are too late and
    left out.
    """

    out = "first long, last long, cnt long"

    def __init__(self, keys: list[str], k: int, slide_us: int):
        self.keys, self.k, self.slide = keys, k, slide_us

    def init(self, handle) -> None:
        self.handle = handle
        self.panes = handle.getListState("panes", "pane long, n long")
        self.at = handle.getValueState("at", "at long")

    def _wake(self, pane: int) -> None:
        """Once the watermark is past ``pane``."""
        self.handle.registerTimer((pane + 1) * self.slide // 1000 - 1)

    def handleInputRows(self, key, rows, timerValues):
        given = self.at.get()[0] if self.at.exists() else None
        new: dict[int, int] = {}
        for r in rows:
            if given is None or r.pane >= given:
                new[r.pane] = new.get(r.pane, 0) + r.n
        if new:
            some = list(new.items())
            for a in range(0, len(some), 1000):
                self.panes.appendList(some[a:a + 1000])
            self._wake(min(new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        through = timerValues.getCurrentWatermarkInMs() * 1000 // self.slide - 1      # the last pane that is complete
        panes: dict[int, int] = {}
        for pane, n in self.panes.get() if self.panes.exists() else ():
            panes[pane] = panes.get(pane, 0) + n
        if not panes:
            return
        at = self.at.get()[0] if self.at.exists() else min(panes)
        if through < at:
            self._wake(at)
            return
        changes: dict[int, int] = {}
        for pane, n in panes.items():
            for where, by in ((max(pane, at), n), (pane + self.k, -n)):
                if where <= through:
                    changes[where] = changes.get(where, 0) + by
        cnt, first = 0, at
        for where in sorted({*changes, through + 1}):
            if cnt and where > first:
                yield Row(**dict(zip(self.keys, key, strict=True)), first=first, last=where - 1, cnt=cnt)
            cnt, first = cnt + changes.get(where, 0), where
        left = [(p, n) for p, n in sorted(panes.items()) if p + self.k > through + 1]
        self.panes.clear()
        self.at.update((through + 1,))
        for a in range(0, len(left), 1000):
            self.panes.appendList(left[a:a + 1000])
        if left:
            ahead = [p for p, _ in left if p > through]
            self._wake(min([left[0][0] + self.k, *ahead]))

    def close(self) -> None:
        pass


def stream_window_runs(df: DataFrame, ts: str | None, keys, size, slide, us: str | None = None) -> DataFrame:
    """Watermarked rows → keys, first, last (numbers of windows by their last pane), cnt.

    The event time is ``ts``, or epoch microseconds in ``us`` where an
    operator before this one has held rows until the watermark.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    size_us, slide_us = to_micros(size), to_micros(slide)
    if size_us % slide_us or slide_us % 1000:
        raise ValueError("the slide must divide the size; it is whole milliseconds")
    time = F.col(us) if us else F.unix_micros(ts)
    x = df.select(*keys, floor_div(time, slide_us).alias("pane"))

    def combine(batches):
        for b in batches:
            got = pa.Table.from_batches([b]).group_by([*keys, "pane"]).aggregate([([], "count_all")])
            yield from got.rename_columns([*keys, "pane", "n"]).to_batches()

    fields = [x.schema[k] for k in keys]
    counted = x.filter("pane IS NOT NULL").mapInArrow(combine, T.StructType([*fields, *T.StructType.fromDDL("pane long, n long").fields]))
    schema = T.StructType([*fields, *T.StructType.fromDDL(PaneRuns.out).fields])
    return counted.groupBy(*keys).transformWithState(PaneRuns(keys, size_us // slide_us, slide_us), schema, "append", "EventTime")


def windows_of(runs: DataFrame, keys, size, slide, name: str = "cnt") -> DataFrame:
    """Runs → keys, window_start, window_end and the count, a row a window."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    size_us, slide_us = to_micros(size), to_micros(slide)
    x = runs.select(*keys, "cnt", F.explode(F.sequence("first", "last")).alias("q"))
    end = (F.col("q") + 1) * F.lit(slide_us)
    ntz = T.TimestampNTZType()
    return x.select(*keys, micros_to(end - F.lit(size_us), ntz).alias("window_start"), micros_to(end, ntz).alias("window_end"), F.col("cnt").alias(name))
