"""SimHash near-duplicates by deletion variants of segments.

With at most ``distance`` differing bits and ``distance // 2 + 1`` segments,
some segment differs in at most one bit.  A fingerprint is indexed under each
segment as it is, and under each of the segment's variants with one bit
replaced by a wildcard; the variants also carry that bit.  Two fingerprints
that agree on a segment meet under the segment itself; two that differ in one
bit of it meet under the variant that hides it, on opposite sides.  So every
close pair meets by an equality join, and only pairs that can be close by
that segment are compared.

Documents with one fingerprint are one class from the start, so groups of
copies cost a row.  A variant shared by very many fingerprints is cut into
tiles, each pair of tiles a task's work of its own; a tile gives a spanning
forest of its links, not the links.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import PREFIX, written
from pulsekit.llm.components import connected_components
from pulsekit.llm.textchunks import forget, give_back
from pulsekit.llm.tiles import deal_pairs, forest, gathered, whole_groups

BITS = 64


def fingerprint_of(text: str, shingle: int = 4) -> int:
    """64 bits, each 1 if set in over half of the shingles' hashes (XXH64, seed 42); no words: 0."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], 42) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist(), strict=False)]
    rows = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    set_bits = np.zeros(BITS, dtype=np.int64)
    for a in range(0, len(rows), 1 << 16):  # bounded room for very long texts
        set_bits += np.unpackbits(rows[a:a + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """``long`` whose bits are the fingerprint of a whole text (null, empty, only white space: 0).

    ASCII letters are lower-cased; words are runs without ASCII white space.
    """
    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        forget()
        got = np.array([fingerprint_of(t.as_py() or "", shingle) for t in texts], dtype=np.uint64)
        give_back()
        return pa.array(got.view(np.int64))

    return prints(text)


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the segments: as few as leave one with at most one differing bit."""
    n = distance // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _values(fp: np.ndarray, distance: int):
    """(segment, its value in each fingerprint)."""
    for s, (first, bits) in enumerate(segments(distance)):
        yield s, bits, (fp >> np.uint64(first) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _key(s: int, wildcard: int, rest: np.ndarray) -> np.ndarray:
    """An index key: segment, the place of its wildcard (64: none), the segment without that bit."""
    return np.int64(s * 128 + wildcard << 40) + rest


def _variants(s: int, bits: int, value: np.ndarray):
    yield _key(s, 64, value)
    for j in range(bits):
        yield _key(s, j, value & ~np.int64(1 << j))


def _index(distance: int, whole_only: bool = False):
    """(key, fp): the entries of each fingerprint, or those of its whole segments only."""
    def run(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            keys = [k for s, bits, v in _values(fp.view(np.uint64), distance)
                    for k in ([_key(s, 64, v)] if whole_only else _variants(s, bits, v))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.tile(fp, len(keys)))], ["key", "fp"])

    return run


def _crowded(distance: int):
    """(key, n) of every entry under which the fingerprints of a crowded segment value come."""
    sizes = [bits for _, bits in segments(distance)]

    def run(batches):
        for batch in batches:
            key, n = batch.column("key").to_numpy(), batch.column("count").to_numpy()
            for s, bits in enumerate(sizes):
                here = key >> 47 == s
                for k in _variants(s, bits, key[here] & np.int64((1 << 40) - 1)):
                    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n[here])], ["key", "n"])

    return run


def links(prints: DataFrame, distance: int, tile: int = 2048) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column ``fp``) that connect all pairs at ``distance`` bits or fewer.

    A key's fingerprints have one of at most two values of its segment, so
    only keys of values with more than ``tile`` fingerprints can be crowded.
    """
    spark = prints.sparkSession
    spread = prints.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "fp")
    entries = spread.mapInArrow(_index(distance), "key long, fp long")
    busy = written(spread.mapInArrow(_index(distance, whole_only=True), "key long, fp long")
                   .groupBy("key").count().filter(F.col("count") > tile), "crowded")
    close, schema = _close(distance), "u long, v long"
    if busy.isEmpty():
        return gathered(entries, ["key"]).mapInArrow(close, schema).distinct()
    tiles = (busy.mapInArrow(_crowded(distance), "key long, n long").groupBy("key")
             .agg((F.ceil(F.sum("n") / tile) + 1).cast("int").alias("tiles")))
    return (gathered(entries.join(tiles, "key", "left_anti"), ["key"]).mapInArrow(close, schema)
            .unionByName(deal_pairs(entries, tiles, ["key"], "fp").mapInArrow(close, schema)).distinct())


def _close(distance: int):
    """Close pairs under each key, or of each pair of tiles of one, as a spanning forest where there are many."""
    cuts_of = segments(distance)

    def run(batches):
        first = next(batches, None)
        if first is None:
            return
        tiled = "a" in first.schema.names
        for t, cuts in whole_groups(itertools.chain([first], batches), ["key", "a", "b"] if tiled else ["key"]):
            fp, slot = t.column("fp").to_numpy().view(np.uint64), t.column("key").to_numpy() >> 40
            whole = slot % 128 == 64
            bit = np.array([a for a, _ in cuts_of])[slot // 128] + np.where(whole, 0, slot % 128)
            side = np.where(whole, 0, fp >> bit.astype(np.uint64) & np.uint64(1)).astype(np.int8)
            tile = t.column("t").to_numpy() if tiled else np.zeros(len(fp), dtype=np.int32)
            cross = t.column("a").to_numpy() != t.column("b").to_numpy() if tiled else np.zeros(len(fp), dtype=bool)
            sizes = np.diff(cuts)
            us, vs = [], []
            for n in np.unique(sizes[sizes > 1]):
                starts = cuts[:-1][sizes == n]
                if n > 64:
                    for s in starts.tolist():
                        u, v = _forest(fp[s:s + n], side[s:s + n], tile[s:s + n], whole[s], cross[s], distance)
                        us.append(u)
                        vs.append(v)
                    continue
                i, j = np.triu_indices(n, 1)  # groups of one size, by far the most, all at once
                at = max(1, (1 << 20) // len(i))
                for k in range(0, len(starts), at):
                    s = starts[k:k + at, None]
                    x, y = (s + i).ravel(), (s + j).ravel()
                    near = np.bitwise_count(fp[x] ^ fp[y]) <= distance
                    near &= (whole[x] | (side[x] != side[y])) & (~cross[x] | (tile[x] != tile[y]))
                    us.append(fp[x[near]])
                    vs.append(fp[y[near]])
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (us, vs)], ["u", "v"])

    return run


def _forest(fp, side, tile, whole: bool, cross: bool, distance: int):
    """Spanning edges of the links in one large pair of tiles."""
    def near(x, left):
        ok = left & (np.bitwise_count(fp ^ fp[x]) <= distance)
        if not whole:
            ok &= side != side[x]
        return ok & (tile != tile[x]) if cross else ok

    edges = np.array(forest(near, len(fp)), dtype=np.int64).reshape(-1, 2)
    return fp[edges[:, 0]], fp[edges[:, 1]]


def components(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, group) of every fingerprint in ``prints`` (fp: long): ``group`` is one of its component's fingerprints."""
    classes = prints.select("fp").distinct()
    nodes = connected_components(links(classes, distance)).select(F.col("node").alias("fp"), F.col("component").alias("group"))
    return classes.join(nodes, "fp", "left").withColumn("group", F.coalesce("group", "fp"))


def near_duplicates(docs: DataFrame, *, distance: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint as long ``fp``, ``component_id``): the smallest id reachable by links of ``distance`` bits or fewer.

    Rows with a null id take part (in what they link) and never name a
    component; a component of only such rows has a null id.
    """
    rows = written(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp")), "fingerprints")
    lows = rows.groupBy("fp").agg(F.min("id").alias("low"))
    named = components(rows, distance).join(lows, "fp")
    found = named.join(named.groupBy("group").agg(F.min("low").alias("component_id")), "group").select("fp", "component_id")
    return rows.join(found, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def representatives(docs: DataFrame, *, distance: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that of the smallest id (null ids last, then by a hash of the text).

    Of rows equal in id and text, but not in other columns, any one stays.
    """
    row = PREFIX + "row"
    name = F.xxhash64(id_col, text_col)
    rows = written(docs.select(F.col(id_col).alias("id"), name.alias("row"), fingerprint(F.col(text_col), shingle).alias("fp")), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")).alias("first")
    stay = (rows.groupBy("fp").agg(first).join(components(rows, distance), "fp")
            .groupBy("group").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row)))
    return docs.withColumn(row, name).join(stay, row).dropDuplicates([row]).select(*docs.columns)
