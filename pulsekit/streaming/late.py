"""Windows that fire again, and ranked lists that follow them.

A window fires when the watermark reaches its end.  For ``lateness`` longer
it is kept: a row that comes then gives a corrected count at once, one
version a row.  After that the window is dropped from state, and a row all
of whose windows are gone is not counted but reported.  Disorder within the
watermark's delay is not late: it only delays the first firing.

Lateness is a property of windows, not of rows, so the processors must see
rows older than the watermark.  Spark filters those only where the event time
column reaches the operator; here times cross as epoch microseconds.

Rows are counted per (key, pane) inside the map tasks before they are
shuffled, so a key with a third of all rows sends one row a pane and task.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from pulsekit.functions.time import floor_div, to_micros

FIRED, LATE, DROPPED = "fired", "late", "dropped"


def _watermark_us(timer_values) -> int:
    return timer_values.getCurrentWatermarkInMs() * 1000


class LateWindows(StatefulProcessor):
    """Counts of one key per sliding window, with corrections for late rows.

    State: a map from window end to (count, version); version -1 has not
    fired.  Spark runs a timer once the watermark is beyond its time, so the
    timers for an end stand a millisecond before it.
    """

    out = "window_end long, cnt long, version int, kind string"

    def __init__(self, keys: list[str], size_us: int, slide_us: int, lateness_us: int):
        self.keys, self.k, self.slide, self.lateness = keys, size_us // slide_us, slide_us, lateness_us

    def init(self, handle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "end long", "cnt long, version int")

    def _row(self, key, end, cnt, version, kind) -> Row:
        return Row(**dict(zip(self.keys, key, strict=True)), window_end=end, cnt=cnt, version=version, kind=kind)

    def _timer(self, us: int) -> None:
        self.handle.registerTimer(us // 1000 - 1)

    def handleInputRows(self, key, rows, timerValues):
        panes: dict[int, int] = {}
        for r in rows:
            panes[r.pane] = panes.get(r.pane, 0) + r.n
        passed = _watermark_us(timerValues)
        for pane, n in sorted(panes.items()):
            ends = [(pane + 1 + j) * self.slide for j in range(self.k)]
            ends = [e for e in ends if e + self.lateness > passed]
            if not ends:
                yield self._row(key, (pane + self.k) * self.slide, n, None, DROPPED)
            for end in ends:
                known = self.windows.containsKey((end,))
                cnt, version = self.windows.getValue((end,)) if known else (0, -1)
                if end > passed:
                    cnt += n
                    if not known:
                        self._timer(end)
                else:
                    if known and version < 0:       # the watermark passed its end just before these rows
                        version = 0
                        yield self._row(key, end, cnt, version, FIRED)
                    for _ in range(n):
                        cnt, version = cnt + 1, version + 1
                        yield self._row(key, end, cnt, version, LATE)
                    if not known:
                        self._timer(end + self.lateness)
                self.windows.updateValue((end,), (cnt, version))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed, at = _watermark_us(timerValues), (expiredTimerInfo.getExpiryTimeInMs() + 1) * 1000
        for end in {at, at - self.lateness}:
            if not self.windows.containsKey((end,)):
                continue
            cnt, version = self.windows.getValue((end,))
            if version < 0:
                yield self._row(key, end, cnt, 0, FIRED)
                self.windows.updateValue((end,), (cnt, 0))
            if end + self.lateness <= passed:
                self.windows.removeKey((end,))
            elif end == at:
                self._timer(end + self.lateness)

    def close(self) -> None:
        pass


def stream_late_windows(df: DataFrame, ts: str, keys, size, slide=None, lateness="60 seconds") -> DataFrame:
    """Counts per key and window of a watermarked stream, corrected while rows may still be late.

    Returns keys, window_end (epoch µs), cnt, version and kind: ``fired``
    (version 0), ``late`` (a correction; the highest version of a window is
    its count) or ``dropped`` (cnt rows came when all their windows were
    gone; window_end is the last of those, version null).  Null keys are a
    key like any other; rows without a time are not counted.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    slide_us, size_us = to_micros(slide or size), to_micros(size)
    if size_us % slide_us or slide_us % 1000 or to_micros(lateness) % 1000:
        raise ValueError("the slide must divide the size; slide and lateness are whole milliseconds")
    x = df.select(*keys, floor_div(F.unix_micros(ts), slide_us).alias("pane")).filter("pane IS NOT NULL")

    def combine(batches):
        for b in batches:
            got = pa.Table.from_batches([b]).group_by([*keys, "pane"]).aggregate([([], "count_all")])
            yield from got.rename_columns([*keys, "pane", "n"]).to_batches()

    schema = T.StructType([*(x.schema[k] for k in keys), T.StructField("pane", T.LongType()), T.StructField("n", T.LongType())])
    counted = x.mapInArrow(combine, schema)
    out = T.StructType([*(x.schema[k] for k in keys), *T.StructType.fromDDL(LateWindows.out).fields])
    return counted.groupBy(*keys).transformWithState(
        LateWindows(keys, size_us, slide_us, to_micros(lateness)), out, "append", "EventTime")


class TopN(StatefulProcessor):
    """The ``n`` best (count descending, key ascending) of a window end, from counts that only grow.

    As counts never fall, an entry that was pushed out comes back only with a
    count of its own that is sent again, so ``n`` entries are all the state
    there is, however many keys the window has.  Each change of the list
    gives the whole list with its revision.  The list goes once the watermark
    is ``keep_us`` past the end.
    """

    def __init__(self, key: str, n: int, keep_us: int):
        self.key, self.n, self.keep = key, n, keep_us

    def init(self, handle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", "list string, revision int")

    def handleInputRows(self, key, rows, timerValues):
        known = self.best.exists()
        text, revision = self.best.get() if known else ("[]", 0)
        before = {k: c for c, k in json.loads(text)}
        best = _best({**before}, ((r[self.key], r.cnt) for r in rows), self.n)
        if dict(best) == before:
            return
        if not known:
            self.handle.registerTimer((key[0] + self.keep) // 1000 - 1)
        self.best.update((json.dumps([[c, k] for k, c in best]), revision + 1))
        for rank, (k, c) in enumerate(best, 1):
            yield Row(window_end=key[0], rank=rank, **{self.key: k}, cnt=c, revision=revision)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.best.clear()
        return iter(())

    def close(self) -> None:
        pass


def _best(entries: dict, more, n: int) -> list[tuple]:
    """The ``n`` best of entries (key: count) and more of them (the larger count of a key holds), in bounded room."""
    room = max(64, 4 * n)

    def cut():
        return sorted(entries.items(), key=lambda e: (-e[1], e[0]))[:n]

    for k, c in more:
        entries[k] = max(c, entries.get(k, c))
        if len(entries) > room:
            entries = dict(cut())
    return cut()


def stream_top_n(counts: DataFrame, key: str, n: int = 3, keep="0 seconds") -> DataFrame:
    """The top ``n`` per window end, revised whenever a count moves it.

    ``counts``: window_end (epoch µs), ``key`` (text or whole numbers; nulls
    are not ranked), cnt; a key's counts in a window only grow (first firings
    and corrections).  Each task sends a micro-batch's ``n`` best of a window end,
    so neither state, memory nor a group's rows grow with the keys: an entry that
    stays behind has ``n`` better ones sent with it.
    Returns window_end, rank, key, cnt and revision; the highest revision of
    a window end is its list.  ``keep`` is how long corrections may come.
    """
    if n < 1:
        raise ValueError("n must be positive")
    field = counts.schema[key]
    end, cnt = T.StructField("window_end", T.LongType()), T.StructField("cnt", T.LongType())

    def cut(batches):
        ends: dict[int, dict] = {}
        kind = None
        for b in batches:
            kind = b.schema.field(1).type
            for e, k, c in zip(*(col.to_pylist() for col in b.columns), strict=True):
                if k is None:
                    continue
                best = ends.setdefault(e, {})
                best[k] = max(c, best.get(k, c))
                if len(best) > max(64, 4 * n):
                    ends[e] = dict(_best(best, (), n))
        rows = [(e, k, c) for e, best in ends.items() for k, c in _best(best, (), n)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), kind, pa.int64()), strict=True)],
                                             ["window_end", key, "cnt"])

    part = counts.select("window_end", key, "cnt").mapInArrow(cut, T.StructType([end, field, cnt]))
    ranked = T.StructType([end, T.StructField("rank", T.IntegerType()), field, cnt, T.StructField("revision", T.IntegerType())])
    return part.groupBy("window_end").transformWithState(TopN(key, n, to_micros(keep)), ranked, "append", "EventTime")


def latest(rows: DataFrame, group: list[str], version: str) -> DataFrame:
    """Of a log of versions, the rows of each group's highest one (all the rows that share it)."""
    best = rows.groupBy(*group).agg(F.max(version).alias("_best"))
    same = best.select(*(F.col(c).alias(f"_{c}") for c in group), "_best")
    on = F.col(version) == F.col("_best")
    for c in group:
        on &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(same, on).select(*rows.columns)
