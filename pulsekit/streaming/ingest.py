"""Ingest time and processing time.

:func:`stamp_ingest` writes each row once with the time at which its
micro-batch was taken in.  Spark keeps that time in the query's log, so a micro-batch
that is run again has the same one, and the file sink shows a
micro-batch once.  Windows over the stored column are therefore the same
however often they are replayed.

:func:`stream_wall_clock_windows` counts by the clock of the run itself: rows
belong to the windows that are open when they come, and a window is given
when the clock passes its end.  A replay would give other windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from pulsekit.functions.time import to_micros
from pulsekit.streaming.io import run_to_table


def stamp_ingest(stream: DataFrame, out: str, checkpoint: str, column: str = "ingest_ts") -> DataFrame:
    """Take in all that is there, append it to the table ``out`` with its ingest time, and return the table.

    A run with the same two folders goes on where the last one stopped.
    """
    return run_to_table(stream.withColumn(column, F.current_timestamp()), "ingest", out=out, checkpoint=checkpoint)


class WallClockWindows(StatefulProcessor):
    """Counts of one key per window of the processing clock; a window is given when the clock has passed it."""

    out = "window_end long, cnt long"

    def __init__(self, keys: list[str], size_ms: int, slide_ms: int):
        self.keys, self.size, self.slide = keys, size_ms, slide_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "end long", "cnt long")

    def handleInputRows(self, key, rows, timerValues):
        n = sum(1 for _ in rows)
        now = timerValues.getCurrentProcessingTimeInMs()
        first = (now // self.slide + 1) * self.slide
        for end in range(first, first + self.size, self.slide):
            if self.counts.containsKey((end,)):
                self.counts.updateValue((end,), (self.counts.getValue((end,))[0] + n,))
            else:
                self.counts.updateValue((end,), (n,))
                self.handle.registerTimer(end)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        end = expiredTimerInfo.getExpiryTimeInMs()
        if self.counts.containsKey((end,)):
            yield Row(**dict(zip(self.keys, key, strict=True)), window_end=end * 1000, cnt=self.counts.getValue((end,))[0])
            self.counts.removeKey((end,))

    def close(self) -> None:
        pass


def stream_wall_clock_windows(df: DataFrame, keys, size, slide=None) -> DataFrame:
    """Rows per key and processing-time window: keys, window_end (epoch µs), cnt.

    Run it with :func:`run_while`: a drain would not end, as the clock always
    may bring another window.  Windows still open when a run stops stay in its
    checkpoint and are given by the next run that finds the clock past them.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    size_ms, slide_ms = to_micros(size) // 1000, to_micros(slide or size) // 1000
    if not slide_ms or size_ms % slide_ms:
        raise ValueError("the slide must divide the size")
    schema = T.StructType([*(df.schema[k] for k in keys), *T.StructType.fromDDL(WallClockWindows.out).fields])
    return df.select(*keys).groupBy(*keys).transformWithState(WallClockWindows(keys, size_ms, slide_ms), schema, "append", "ProcessingTime")
