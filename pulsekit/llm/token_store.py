"""Token ids as binary blocks of byte or bit planes, with a chunk index.

Documents are range-sorted by id; the ids of each range are one stream, cut
into blocks of a fixed number of ids.  A block is transposed, so that plane
*k* holds byte (or bit) *k* of every id, and each plane is compressed by
zstandard on its own: high planes are nearly constant and shrink to almost
nothing.  A block is one row of ``blocks/``, with the documents that begin in
it; ``index/`` has one row per block with its place in the whole stream, the
sizes of its planes and a checksum, so a reader can fetch any run of ids
without touching other blocks.  Both are tables, so they live on any store
that Spark writes, and a lost task's blocks are written again or not at all.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsekit.llm.library_ids import library_ids

BLOCK_IDS = 1 << 16
_BLOCK = ("part int, block int, first long, n_ids int, mode string, planes array<binary>, crc long, "
          "carry_start long, carry int, docs array<struct<doc_id:long,at:long,n:long>>")
_BLOCK_ARROW = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()), ("mode", pa.string()),
    ("planes", pa.list_(pa.binary())), ("crc", pa.int64()), ("carry_start", pa.int64()), ("carry", pa.int32()),
    ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("at", pa.int64()), ("n", pa.int64())])))])
_SEGMENT = "part int, at long, doc_id long, n long, seq int, ids binary"
_SEGMENT_ARROW = pa.schema([("part", pa.int32()), ("at", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()),
                            ("seq", pa.int32()), ("ids", pa.binary())])


def to_planes(ids: np.ndarray, mode: str = "byte") -> list[bytes]:
    """The compressed planes of a block of ids, low plane first."""
    import zstandard

    rows = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if mode == "byte":
        planes = rows.T
    elif mode == "bit":
        planes = np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1)
    else:
        raise ValueError(f"unknown plane mode {mode!r}")
    pack = zstandard.ZstdCompressor(level=3)
    return [pack.compress(np.ascontiguousarray(p).tobytes()) for p in planes]


def from_planes(planes: list[bytes], n_ids: int, mode: str = "byte") -> np.ndarray:
    """The ids of a block."""
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    raw = [np.frombuffer(unpack.decompress(p), dtype=np.uint8) for p in planes]
    rows = np.stack(raw, axis=1) if mode == "byte" else np.packbits(
        np.stack([np.unpackbits(p, count=n_ids) for p in raw], axis=1), axis=1, bitorder="little")
    return np.ascontiguousarray(rows).view("<u4").reshape(-1)


class _Blocks:
    """Cuts one range's stream of documents into rows of ``blocks/``."""

    def __init__(self, part: int, block_ids: int, mode: str):
        self.part, self.size, self.mode = part, block_ids, mode
        self.held, self.n_held, self.first, self.block = [], 0, 0, 0
        self.docs, self.carry, self.carry_start = [], 0, None

    def add(self, doc_id, ids: np.ndarray):
        start = self.first + self.n_held
        self.docs.append({"doc_id": doc_id, "at": start, "n": len(ids)})
        while len(ids):
            some = ids[:self.size - self.n_held]
            self.held.append(some)
            self.n_held += len(some)
            ids = ids[len(some):]
            if self.n_held == self.size:
                yield self.row()
                if len(ids):
                    self.carry, self.carry_start = min(len(ids), self.size), start

    def row(self) -> dict:
        ids = np.concatenate(self.held)
        out = {"part": self.part, "block": self.block, "first": self.first, "n_ids": len(ids), "mode": self.mode,
               "planes": to_planes(ids, self.mode), "crc": zlib.crc32(ids.tobytes()),
               "carry_start": self.carry_start, "carry": self.carry, "docs": self.docs}
        self.first += len(ids)
        self.block += 1
        self.held, self.n_held, self.docs, self.carry, self.carry_start = [], 0, [], 0, None
        return out


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, *, doc_col: str = "doc_id",
              text_col: str = "text", block_ids: int = BLOCK_IDS, mode: str = "byte") -> None:
    """Encode ``text_col`` (null: empty), close each document with ``end_id``, and write blocks and index to ``path``.

    Documents go in ascending ``doc_col`` (nulls first, ties by the text's
    hash).  One shuffle, of the texts; other columns are not read.
    """
    rows = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]

    def blocks(batches):
        out = _Blocks(TaskContext.get().partitionId(), block_ids, mode)
        for batch in batches:
            names = iter(batch.column("doc_id").to_pylist())
            for ids, at in library_ids(tokenizer, batch.column("text"), end_id):
                for a, b in itertools.pairwise(at.tolist()):
                    yield from map(_as_batch, out.add(next(names), ids[a:b]))
        if out.n_held:
            yield _as_batch(out.row())

    (rows.repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(blocks, _BLOCK).write.option("compression", "uncompressed").parquet(f"{path}/blocks"))
    spark = docs.sparkSession
    written = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    sizes = written.select("part", "block", "first", "n_ids", "mode", "crc", F.size("docs").alias("n_docs"),
                           F.transform("planes", F.octet_length).alias("plane_bytes"))
    starts = _part_starts(sizes)
    (sizes.join(starts, "part").withColumn("start", F.col("part_start") + F.col("first"))
     .drop("part_start").write.parquet(f"{path}/index"))


def _as_batch(row: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([row], schema=_BLOCK_ARROW)


def _part_starts(index: DataFrame) -> DataFrame:
    """Ids before each range: a running sum over one row per range."""
    totals = index.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids (packed ``binary``).

    A document that lies in one block comes straight from it; the pieces of
    one that crosses blocks are brought together by its place.
    """
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    starts = _part_starts(spark.read.parquet(f"{path}/index"))
    whole = blocks.mapInArrow(_segments(True), _SEGMENT)
    parts = (blocks.mapInArrow(_segments(False), _SEGMENT).groupBy("part", "at")
             .agg(F.max("doc_id").alias("doc_id"), F.max("n").alias("n"),
                  F.sort_array(F.collect_list(F.struct("seq", "ids"))).alias("some"))
             .select("part", "at", "doc_id", "n", F.aggregate("some", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")))
    return (whole.select("part", "at", "doc_id", "n", "ids").unionByName(parts).join(starts, "part")
            .select("doc_id", (F.col("part_start") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), "ids"))


def _segments(whole: bool):
    """The ids of documents inside one block, or the pieces of those that cross blocks."""
    def run(batches):
        for batch in batches:
            for b in batch.to_pylist():
                end = b["first"] + b["n_ids"]
                docs = [(d["at"], d["doc_id"], d["n"]) for d in b["docs"] if (d["at"] + d["n"] <= end) == whole]
                if not docs and (whole or not b["carry"]):
                    continue
                ids = from_planes(b["planes"], b["n_ids"], b["mode"])
                if zlib.crc32(ids.tobytes()) != b["crc"]:
                    raise ValueError(f"block {b['part']}/{b['block']} is damaged")
                data = ids.tobytes()
                rows = [(b["part"], at, doc, n, b["block"], data[4 * (at - b["first"]):4 * (min(at + n, end) - b["first"])])
                        for at, doc, n in docs]
                if not whole and b["carry"]:
                    rows.append((b["part"], b["carry_start"], None, None, b["block"], data[:4 * b["carry"]]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SEGMENT_ARROW, strict=True)],
                                                 schema=_SEGMENT_ARROW)

    return run
