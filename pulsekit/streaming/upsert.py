"""A keyed table that a stream upserts into (K3): deltas, snapshots and a log of what counts.

Layout under one folder: ``delta/epoch=N`` holds the rows of an epoch, one a
key, in ``buckets`` files by key hash; ``snapshot/epoch=N`` the whole table
as of an epoch; ``log/epoch=N`` a one-row table that says the epoch is
complete and whether it has a snapshot.  Data is written before its log
entry, so a reader sees an epoch whole or not at all, and an epoch that is
replayed after a failure writes the same folders over.

A read takes the last snapshot and the deltas after it; every ``compact_every``
epochs they become a new snapshot, so a read costs the keys and a bounded
number of deltas, not the history.  One writer at a time (a stream's sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG = "epoch long, snapshot boolean"


class UpsertTable:
    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, keys: list[str], buckets: int = 16, compact_every: int = 10):
        self.spark, self.path, self.keys, self.buckets, self.every = spark, path.rstrip("/"), list(keys), buckets, compact_every
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if not self.keys or not set(self.keys) <= set(self.schema.names):
            raise ValueError("the keys must be columns of the table")
        spark.createDataFrame([], _LOG).write.mode("append").parquet(f"{self.path}/log")

    def _committed(self, up_to: int | None = None) -> list[tuple[int, bool]]:
        """(epoch, has a snapshot) of the complete epochs, in order: a row an epoch since the table began."""
        log = self.spark.read.schema(_LOG).parquet(f"{self.path}/log")
        rows = log.groupBy("epoch").agg(F.max("snapshot").alias("snapshot")).orderBy("epoch").collect()
        return [(r.epoch, r.snapshot) for r in rows if up_to is None or r.epoch <= up_to]

    def _commit(self, epoch: int, snapshot: bool) -> None:
        self.spark.createDataFrame([(epoch, snapshot)], _LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def _read(self, kind: str, epochs: list[int]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("epoch", T.LongType())])
        if not epochs:
            return self.spark.createDataFrame([], schema)
        # folders are named one by one: what is not in the log is never read
        parts = [self.spark.read.schema(self.schema).parquet(f"{self.path}/{kind}/epoch={e}").withColumn("epoch", F.lit(e).cast("long")) for e in epochs]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _write(self, df: DataFrame, kind: str, epoch: int) -> None:
        df.select(*self.schema.names).repartition(self.buckets, *self.keys).write.mode("overwrite").parquet(f"{self.path}/{kind}/epoch={epoch}")

    def upsert(self, rows: DataFrame, epoch: int, order: str | None = None) -> None:
        """Rows of one epoch replace those of their keys.  Of a key that comes twice the row of the greatest ``order`` counts
        (of equal ones, the greatest row).  An epoch that is complete already is left as it is: nothing happens twice."""
        done = self._committed()
        if any(e == epoch for e, _ in done):
            return
        rest = [c for c in self.schema.names if c not in self.keys]
        best = F.struct((F.col(order) if order else F.lit(0)).alias("o"), F.struct(*rest).alias("row"))
        one = rows.groupBy(*self.keys).agg(F.max(best).alias("_r")).select(*self.keys, *(F.col(f"_r.row.{c}").alias(c) for c in rest))
        self._write(one, "delta", epoch)
        self._commit(epoch, False)
        since = [e for e, _ in done if e > max((x for x, s in done if s), default=-1)]
        if len(since) + 1 >= self.every:
            self.compact()

    def current(self, epoch: int | None = None) -> DataFrame:
        """The table as of the last complete epoch (or an earlier one, while its deltas are there)."""
        done = self._committed(epoch)
        base = max((e for e, s in done if s), default=None)
        rows = self._read("delta", [e for e, _ in done if base is None or e > base])
        if base is not None:
            rows = rows.unionByName(self._read("snapshot", [base]))
        rest = [c for c in self.schema.names if c not in self.keys]
        # keys are unique within an epoch and within a snapshot
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct("epoch", *rest), "epoch").alias("_r"))
        return last.select(*(F.col(c) if c in self.keys else F.col(f"_r.{c}").alias(c) for c in self.schema.names))

    def compact(self) -> None:
        """Write the table as of now as a snapshot; deltas up to it are not read any more."""
        done = self._committed()
        if done and not done[-1][1]:
            self._write(self.current(), "snapshot", done[-1][0])
            self._commit(done[-1][0], True)
