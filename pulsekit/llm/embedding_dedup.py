"""Near-duplicate vectors by a pigeonhole join on subspaces.

Unit vectors with cosine >= c lie within squared distance 2 - 2c.  After a
fixed rotation the coordinates are split into blocks of a few dimensions,
each with a share of that budget in proportion to its dimensions; two close
vectors cannot exceed the share in every block.  In each block a range join
finds the pairs within its share: a grid over the block's first coordinates,
with cells two radii wide, brings a vector to its own cell and to the smaller
neighbour cells within reach, so each pair meets in one cell; there the block
distance is computed for all dimensions of the block.  A candidate counts in
the first block that holds it and is verified on the original vectors in
double precision at once, so the union needs no shuffle of pairs.

Equal vectors are one class from the start.  A crowded cell is cut into
tiles; a tile gives the number of links of each class and a spanning forest,
never its pairs.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import PREFIX, written
from pulsekit.llm.components import connected_components
from pulsekit.llm.embeddings import matrix, products, rotation, usable
from pulsekit.llm.tiles import deal_pairs, whole_groups

_SLACK = 1e-9
_CELL = ["dim", "block", "cell"]


class Subspaces:
    """Blocks of rotated coordinates and their budgets, for vectors of one length."""

    def __init__(self, dim: int, min_cosine: float, block_dims: int, grid_dims: int):
        self.turn = rotation(dim)
        n = max(1, dim // block_dims)
        self.cuts = [dim * i // n for i in range(n + 1)]
        self.budgets = np.diff(self.cuts) / dim * (2 - 2 * min_cosine + _SLACK)
        self.grid_dims = grid_dims

    def rotated(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors, rotated; each row the same whatever rows are with it."""
        unit = x / np.sqrt(products(x, x))[:, None]
        return np.einsum("ij,kj->ik", unit, self.turn, optimize=False)

    def cells(self, y: np.ndarray):
        """(block, rows, cells, at home) for the cells that each vector comes to in each block."""
        for b, (lo, hi) in enumerate(itertools.pairwise(self.cuts)):
            g = min(self.grid_dims, hi - lo)
            reach = np.sqrt(self.budgets[b])
            at = y[:, lo:lo + g] / (2 * reach)
            home = np.floor(at).astype(np.int64)
            part = at - home
            for step in itertools.product((-1, 0, 1), repeat=g):
                if next((s for s in step if s), -1) > 0:
                    continue
                off = np.array(step)
                gap = np.where(off < 0, part, np.where(off > 0, 1 - part, 0.0))
                rows = np.flatnonzero((gap ** 2).sum(axis=1) <= 0.25 + _SLACK)
                code = np.zeros(len(rows), dtype=np.int64)
                for c in range(g):
                    code = code * 2_000_003 + home[rows, c] + step[c]
                yield b, rows, code, not any(step)

    def first_here(self, x: np.ndarray, u: np.ndarray, v: np.ndarray, b: int):
        """The pairs of rows whose first block within its share is ``b``; one sum order, so every tile agrees."""
        if len(u):
            rows, back = np.unique(np.concatenate([u, v]), return_inverse=True)
            y = self.rotated(x[rows])
            square = (y[back[:len(u)]] - y[back[len(u):]]) ** 2
            within = np.add.reduceat(square, self.cuts[:-1], axis=1) <= self.budgets
            here = within.argmax(axis=1) == b
            u, v = u[here & within[:, b]], v[here & within[:, b]]
        return u, v


def _spread(make):
    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == dim))
                space = make(dim)
                for b, rows, code, home in space.cells(space.rotated(matrix(some.column("vec"), dim))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), x, dtype=np.int32)) for x in (dim, b)]
                        + [pa.array(code), pa.array(np.full(len(rows), home))]
                        + [some.column(c).take(pa.array(rows)) for c in ("cid", "n", "vec")],
                        ["dim", "block", "cell", "home", "cid", "n", "vec"])

    return run


def _linked(make, min_cosine: float):
    """Links inside pairs of tiles: (u, null, linked vectors) for counts and (u, v, 0) for a spanning forest."""
    def run(batches):
        for t, cuts in whole_groups(batches, [*_CELL, "a", "b"]):
            for s, e in itertools.pairwise(cuts.tolist()):
                if e - s > 1:
                    yield from _tile(t.slice(s, e - s), make, min_cosine)

    return run


def _tile(t: pa.Table, make, min_cosine: float):
    dim, block = t.column("dim")[0].as_py(), t.column("block")[0].as_py()
    tile, home = t.column("t").to_numpy(), t.column("home").to_numpy()
    cid, weight = t.column("cid").to_numpy(), t.column("n").to_numpy()
    space, x = make(dim), matrix(t.column("vec"), dim)
    norm = np.sqrt(products(x, x))
    part = ((x / norm[:, None]) @ space.turn[space.cuts[block]:space.cuts[block + 1]].T).astype(np.float32)
    square = (part ** 2).sum(axis=1)
    a, b = t.column("a")[0].as_py(), t.column("b")[0].as_py()
    if a == b:
        meet = [(np.flatnonzero(home), np.arange(len(x)))]
    else:  # two visitors meet in another cell
        meet = [(np.flatnonzero((tile == a) & home), np.flatnonzero(tile == b)),
                (np.flatnonzero((tile == a) & ~home), np.flatnonzero((tile == b) & home))]
    counts, groups, edges = np.zeros(len(x), dtype=np.int64), np.arange(len(x)), []
    most = np.float32(space.budgets[block] + 1e-5)
    for some, other in ((own[i:i + 256], other) for own, other in meet for i in range(0, len(own), 256)):
        near = part[some] @ (-2 * part[other].T)
        near += square[other]
        p, q = np.nonzero(near <= (most - square[some])[:, None])
        p, q = some[p], other[q]
        if a == b:
            ok = ~home[q] | (p < q)
            p, q = p[ok], q[ok]
        for j in range(0, len(p), 1 << 16):
            u, v = p[j:j + (1 << 16)], q[j:j + (1 << 16)]
            ok = products(x[u], x[v]) / (norm[u] * norm[v]) >= min_cosine
            u, v = space.first_here(x, u[ok], v[ok], block)
            counts += np.bincount(u, weight[v], len(x)).astype(np.int64) + np.bincount(v, weight[u], len(x)).astype(np.int64)
            while len(u := u[new := groups[u] != groups[v]]):  # one link at a time joins two groups
                v = v[new]
                edges.append((u[0], v[0]))
                groups[groups == groups[v[0]]] = groups[u[0]]
    has = np.flatnonzero(counts)
    if len(has):
        pairs = np.array(edges, dtype=np.int64).reshape(-1, 2)
        none = np.zeros(len(has), dtype=np.int64)
        u = np.concatenate([cid[has], cid[pairs[:, 0]]])
        v = pa.array(np.concatenate([none, cid[pairs[:, 1]]]), mask=np.arange(len(u)) < len(has))
        yield pa.RecordBatch.from_arrays([pa.array(u), v, pa.array(np.concatenate([counts[has], np.zeros(len(pairs), dtype=np.int64)]))],
                                         ["u", "v", "n"])


def near_duplicates(vectors: DataFrame, *, min_cosine: float = 0.95, block_dims: int = 8, grid_dims: int = 2, tile: int = 16_384,
                    id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per vector: id, n_links (other vectors with cosine >= ``min_cosine``), component_id (smallest id reachable), kept.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing and are their own component; so do rows with a null id
    (component null, kept null).  Vectors of different lengths never link.
    Repeated rows are vectors of their own that link with each other.
    """
    vec = PREFIX + "vec"
    rows = vectors.select(F.col(id_col).cast("long").alias(id_col), F.col(vec_col).alias(vec))
    good = rows.filter(F.col(id_col).isNotNull() & usable(vec))
    classes = written(good.groupBy(vec).agg(F.min(id_col).alias("low"), F.count("*").alias("n"))
                      .select("low", "n", F.col(vec).alias("vec"), F.size(vec).alias("dim"), F.monotonically_increasing_id().alias("cid")), "vectors")

    def make(dim, seen={}):  # noqa: B006  a worker's own
        if dim not in seen:
            seen[dim] = Subspaces(dim, min_cosine, block_dims, grid_dims)
        return seen[dim]

    kind = classes.schema["vec"].dataType.simpleString()
    cells = classes.select("cid", "n", "dim", "vec").mapInArrow(
        _spread(make), f"dim int, block int, cell long, home boolean, cid long, n long, vec {kind}")
    sizes = (classes.select("cid", "n", "dim", "vec").mapInArrow(_spread(make), cells.schema).groupBy(*_CELL)
             .agg(F.count("*").alias("n"), F.max("home").alias("home")).filter((F.col("n") > 1) & F.col("home"))
             .select(*_CELL, F.ceil(F.col("n") / tile).cast("int").alias("tiles")))
    found = written(deal_pairs(cells, sizes, _CELL, "cid").mapInArrow(_linked(make, min_cosine), "u long, v long, n long"), "links")
    counts = found.filter(F.col("v").isNull()).groupBy(F.col("u").alias("cid")).agg(F.sum("n").alias("linked"))
    nodes = connected_components(found.filter(F.col("v").isNotNull()).select("u", "v")).select(F.col("node").alias("cid"), "component")
    named = (classes.select("cid", "low", "n", "vec").join(counts, "cid", "left").join(nodes, "cid", "left")
             .withColumn("component", F.coalesce("component", "cid")))
    lows = named.groupBy("component").agg(F.min("low").alias("root"))
    found_rows = named.join(lows, "component").select(
        F.col("vec").alias(vec), (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), "root")
    own = F.col(id_col)
    linked = good.join(found_rows, vec).select(id_col, "n_links", F.col("root").alias("component_id"))
    alone = rows.filter(own.isNull() | ~usable(vec)).select(id_col, F.lit(0).cast("long").alias("n_links"), own.alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col(id_col) == F.col("component_id"))
