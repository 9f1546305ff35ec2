"""Stream sources, the end of input (H1) and sinks.

Streams carry ``timestamp`` event times (watermarks need them); the batch
tables are ``timestamp_ntz``.  The session zone is UTC, so the casts between
the two keep the wall clock.

End of input: append mode emits a window only after the watermark passes it,
and a finite input never moves the watermark past its own tail.  A stream is
therefore read together with a second one over a folder that stays empty
while the data is drained, in as many micro-batches as it takes.  Then a
one-row marker is put into that folder and the same query runs once more on
its checkpoint, which closes what is still open.  A marker far in the future
is final: the checkpoint's watermark is then ahead of any later row.  A marker
``until`` some time closes what ends by then, and no more: later rows go on.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions.time import to_micros
from pulsekit.session import ensure_utc, scratch_path

MARKER = "_end_marker"
# Fixed value: the marker's event time, far beyond any real event.
MARKER_TS = "2999-12-31 00:00:00"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """The parquet table ``name`` of ``sf_dir``, a file or a folder of part files, as a stream (NTZ columns become timestamp).

    Files come by their modification time, ``max_files`` a micro-batch.
    """
    ensure_utc(spark)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    table = spark.read.parquet(path)
    schema, files = table.schema, table.inputFiles()
    one_file = len(files) == 1 and files[0].rstrip("/").endswith(f"/{name}.parquet")
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    df = r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir) if one_file else r.parquet(path)
    for f in schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp"))
    return df


class Ending:
    """The ends of a query's inputs: attached to its streams, released when they are drained.

    ``folder`` keeps the markers where a later run of the same query finds
    them; without it they are in a fresh folder.  ``at_once``: the input is
    one micro-batch, so its end may come with it (the watermark moves only
    after a micro-batch) and the query is started once, not twice.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, at_once: bool = False):
        self.spark, self.folder, self.at_once = spark, folder, at_once
        self.markers: list[tuple[DataFrame, str, str, str]] = []

    def close(self, stream: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
        """Filtered and projected ``stream`` with its watermark; its windows close when the end is released.

        Only stateful steps should follow: Catalyst pushes deterministic
        filters that do not read the event time below the watermark and into
        both inputs, where they would drop the marker, whose other fields are
        null.  The marker itself is removed by a filter that reads the time.
        """
        path = f"{self.folder}/{len(self.markers)}" if self.folder else scratch_path(self.spark, "marker")
        blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields if f.name != ts]
        row = self.spark.range(1).select(*blank, F.to_timestamp(F.lit(MARKER_TS)).alias(ts)).select(*stream.columns)
        row.limit(0).write.mode("append").parquet(path)
        self.markers.append((row, path, ts, delay))
        end = self.spark.readStream.schema(stream.schema).parquet(path)
        both = (stream.withColumn(MARKER, F.lit(False)).unionByName(end.withColumn(MARKER, F.lit(True)))
                .withWatermark(ts, delay))
        never = F.col(ts) < F.to_timestamp(F.lit("0001-01-01 00:00:00"))
        return both.filter(F.when(F.col(MARKER), never).otherwise(F.lit(True))).drop(MARKER)

    def release(self, until: str | None = None) -> None:
        """Close the inputs: up to ``until`` (the watermark goes there, unless it is ahead), or for good."""
        for row, path, ts, delay in self.markers:
            if until:
                row = row.withColumn(ts, F.timestamp_micros(F.unix_micros(F.to_timestamp(F.lit(until))) + to_micros(delay)))
            row.coalesce(1).write.mode("append").parquet(path)


def _start(df: DataFrame, out: str | None, checkpoint: str, mode: str, each=None, **trigger):
    """A parquet sink, or ``each(batch, epoch)``, on a state store that keyed processors can use."""
    spark = df.sparkSession
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)  # read when the query starts
    try:
        w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**trigger)
        return w.foreachBatch(each).start() if each else w.format("parquet").start(out)
    finally:
        spark.conf.set(_PROVIDER, before)


def run_each(df: DataFrame, checkpoint: str, each, mode: str = "update") -> None:
    """Drain the input through ``each(batch, epoch)``; a run with the same checkpoint goes on where the last one stopped."""
    q = _start(df, None, checkpoint, mode, each, availableNow=True)
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def run_while(df: DataFrame, out: str, checkpoint: str, going, interval: str = "1 second", mode: str = "append", limit: float = 600) -> DataFrame:
    """Run with a trigger every ``interval`` while ``going(progress)`` holds, then stop, and read the sink back.

    ``going`` gets the progress of each finished micro-batch (a dictionary)
    and is asked again after every one; after ``limit`` seconds the run stops
    anyway.  A later run with the same folders goes on from there.
    """
    q, began, seen = _start(df, out, checkpoint, mode, processingTime=interval), time.monotonic(), None
    try:
        while time.monotonic() - began < limit and q.isActive:
            last = q.lastProgress
            if last and last["batchId"] != seen:
                seen = last["batchId"]
                if not going(last):
                    break
            q.awaitTermination(0.1)
    finally:
        q.stop()
    if q.exception():
        raise q.exception()
    return df.sparkSession.read.schema(df.schema).parquet(out)


def run_to_table(df: DataFrame, name: str, ending: Ending | None = None, mode: str = "append",
                 out: str | None = None, checkpoint: str | None = None, until: str | None = None) -> DataFrame:
    """Run a streaming query over everything available, write parquet, read it back.

    ``out`` and ``checkpoint`` name the sink and the query's progress: a run
    with the same two goes on where the last one stopped.  Without them both
    are fresh folders under ``spark.checkpoint.dir``.  With an ``ending`` the
    inputs are drained first, then closed: up to ``until``, or for good.
    """
    spark = df.sparkSession
    out = out or scratch_path(spark, f"{name}-out")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")

    def drain() -> None:
        q = _start(df, out, checkpoint, mode, availableNow=True)
        q.awaitTermination()
        if q.exception():
            raise q.exception()

    if ending and ending.at_once:
        ending.release(until)
        drain()
    else:
        drain()
        if ending:
            ending.release(until)
            drain()
    return spark.read.schema(df.schema).parquet(out)


def run_batches_to_table(df: DataFrame, name: str, transform, ending: Ending | None = None, mode: str = "append",
                         out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """As :func:`run_to_table`, with each micro-batch of results put through ``transform``, a batch query.

    An epoch has its own folder, written over on a replay, so no row comes twice.
    """
    spark = df.sparkSession
    out, checkpoint = out or scratch_path(spark, f"{name}-out"), checkpoint or scratch_path(spark, f"{name}-ckpt")

    def each(batch: DataFrame, epoch: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/epoch_id={epoch}")

    steps = [lambda: run_each(df, checkpoint, each, mode)]
    if ending:
        steps = [ending.release, *steps] if ending.at_once else [*steps, ending.release, *steps]
    for step in steps:
        step()
    return spark.read.parquet(out).drop("epoch_id")


def arrivals(rows: DataFrame, load: str, loads: int, path: str):
    """Append the rows of each load to the folder that a stream reads, in order; the caller runs the stream in between."""
    for i in range(loads):
        rows.filter(F.col(load) == i).drop(load).write.mode("append").parquet(path)
        yield i


def write_outputs(df: DataFrame, targets: dict, epoch_id: int) -> None:
    """``foreachBatch`` body writing several tagged outputs of one micro-batch (K2).

    ``targets`` maps a ``status`` value to an output folder.  Each epoch has
    its own sub-folder, written over on a replay, so no row comes twice.
    """
    df.persist()
    try:
        for tag, path in targets.items():
            df.filter(F.col("status") == tag).write.mode("overwrite").parquet(f"{path}/epoch_id={epoch_id}")
    finally:
        df.unpersist()


def upsert_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Read a log written per epoch (:func:`write_outputs`) and keep the latest row per key (K3)."""
    log = spark.read.parquet(path)
    w = Window.partitionBy(*keys).orderBy(F.col("epoch_id").desc())
    return log.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "epoch_id")
