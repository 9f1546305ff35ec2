"""Nearest neighbours by inner product: multiprobe p-stable hashing.

Largest inner product is made nearest distance: with M the largest norm, x
becomes (x / M, sqrt(1 - |x|^2 / M^2)) and a query q becomes (q / |q|, 0), so
nearer is larger.  A table's hash is a few values floor((a . x + b) / width)
with normal, hence 2-stable, a.  A query does not visit its own bucket only
but a sequence of perturbed ones, where single values are one lower or
higher, in the order of their estimated success: the sum of squared distances
to the boundaries crossed.  That order is a template over the sorted
distances, the same for every query, so a query's buckets are a gather (Lv et
al., 2007).  Candidates of all tables are ranked by the exact measure.

Equal vectors are one class.  A bucket's members and queries are both cut
into parts, each pair of parts a task's work of its own, from which only the
best of each query leave.
"""

from __future__ import annotations

import itertools
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.llm.common import PREFIX, written
from pulsekit.llm.embeddings import matrix, products, usable
from pulsekit.llm.tiles import gathered, whole_groups

_KEY = ["dim", "slot", "bucket", "part", "qpart"]


@lru_cache(maxsize=4)
def probe_template(hashes: int, probes: int) -> np.ndarray:
    """Rows of 0/1 over the 2 * hashes sorted boundary distances: the sets to cross, likeliest first.

    Place j and its mirror are the two sides of one value, so no set has
    both.  The expected squared distances are those of sorted uniform ones.
    """
    m = hashes
    j = np.arange(1, m + 1)
    near = j * (j + 1) / (4 * (m + 1) * (m + 2))
    far = 1 - j / (m + 1) + j * (j + 1) / (4 * (m + 1) * (m + 2))
    sets = np.array(list(itertools.product((0, 1, 2), repeat=m)))
    cost = ((sets == 1) * near + (sets == 2) * far).sum(axis=1)
    sets = sets[np.argsort(cost, kind="stable")[:probes]]
    return np.concatenate([sets == 1, (sets == 2)[:, ::-1]], axis=1).astype(np.int64)


class Tables:
    """The hashes of all tables for vectors of one length."""

    def __init__(self, dim: int, tables: int, hashes: int, width: float, seed: int = 5):
        random = np.random.default_rng([seed, dim])
        self.lines = random.standard_normal((tables, dim + 1, hashes))
        self.shift = random.uniform(0, 1, (tables, hashes))
        self.width = width
        self.weights = np.array([1_000_003 ** i % (1 << 40) for i in range(hashes)], dtype=np.int64)

    def places(self, x: np.ndarray, table: int) -> np.ndarray:
        return x @ self.lines[table] / self.width + self.shift[table]

    def bucket(self, x: np.ndarray, table: int) -> np.ndarray:
        return np.floor(self.places(x, table)).astype(np.int64) @ self.weights

    def probes(self, q: np.ndarray, table: int, probes: int) -> np.ndarray:
        """For each query its buckets, one per column, in order of estimated success."""
        place = self.places(q, table)
        home = np.floor(place)
        low = place - home
        m = place.shape[1]
        order = np.argsort(np.concatenate([low, 1 - low], axis=1), axis=1, kind="stable")
        change = np.where(order < m, -1, 1) * self.weights[order % m]
        return (home.astype(np.int64) @ self.weights)[:, None] + change @ probe_template(m, probes).T


def _lifted(x: np.ndarray, largest: float | None) -> np.ndarray:
    """Members against the ``largest`` norm, or queries (None)."""
    square = products(x, x)
    if largest is None:
        return np.concatenate([x / np.sqrt(square)[:, None], np.zeros((len(x), 1))], axis=1)
    return np.concatenate([x / largest, np.sqrt(np.maximum(0, 1 - square / largest ** 2))[:, None]], axis=1)


def _entries(make, probes: int | None, largest: dict[int, float]):
    """(dim, slot, bucket, cid, vec) of members (one bucket a table) or queries (``probes`` buckets a table)."""
    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == dim))
                x = matrix(some.column("vec"), dim)
                tables = make(dim)
                lifted = _lifted(x, largest[dim] if probes is None else None)
                for table in range(len(tables.lines)):
                    got = tables.bucket(lifted, table)[:, None] if probes is None else tables.probes(lifted, table, probes)
                    rows = np.repeat(np.arange(len(x)), got.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), v, dtype=np.int32)) for v in (dim, table)] + [pa.array(got.ravel())]
                        + [some.column(c).take(pa.array(rows)) for c in ("cid", "low", "vec")], ["dim", "slot", "bucket", "cid", "low", "vec"])

    return run


def _best(members: DataFrame, queries: DataFrame, k: int, part_rows: int) -> DataFrame:
    """(query, cid, low, score): the ``k`` best members of each query in each pair of parts of the buckets they share."""
    bucket = ["dim", "slot", "bucket"]
    parts = (members.groupBy(*bucket).agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"))
             .join(queries.groupBy(*bucket).agg(F.ceil(F.count("*") / part_rows).cast("int").alias("qparts")), bucket))

    def dealt(rows, own, n_own, other, n_other):
        return (rows.join(parts, bucket).withColumn(own, F.pmod(F.xxhash64("cid"), F.col(n_own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(n_other) - 1))).drop("parts", "qparts"))

    both = (dealt(members, "part", "parts", "qpart", "qparts").withColumn("asks", F.lit(False))
            .unionByName(dealt(queries, "qpart", "qparts", "part", "parts").withColumn("asks", F.lit(True))))

    def run(batches):
        for t, cuts in whole_groups(batches, _KEY):
            for s, e in itertools.pairwise(cuts.tolist()):
                yield from _ranked(t.slice(s, e - s), k)

    return gathered(both, _KEY).mapInArrow(run, "query long, cid long, low long, score double")


def _ranked(t: pa.Table, k: int):
    dim, asks = t.column("dim")[0].as_py(), t.column("asks").to_numpy()
    if asks.all() or not asks.any():
        return
    x = matrix(t.column("vec"), dim)
    cid, low = t.column("cid").to_numpy(), t.column("low").to_numpy()
    members, queries = np.flatnonzero(~asks), np.flatnonzero(asks)
    for i in range(0, len(queries), 256):
        some = queries[i:i + 256]
        score = x[some] @ x[members].T
        if len(members) > k:  # all that may be among the k best, ties at the edge included
            edge = np.partition(score, len(members) - k, axis=1)[:, len(members) - k]
            a, b = np.nonzero(score >= edge[:, None] - 1e-9 * (1 + np.abs(edge[:, None])))
        else:
            a, b = (v.ravel() for v in np.indices(score.shape))
        exact = products(x[some[a]], x[members[b]])
        order = np.lexsort((low[members[b]], -exact, a))
        a, b, exact = a[order], b[order], exact[order]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        a, b, exact = a[place < k], b[place < k], exact[place < k]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (cid[some[a]], cid[members[b]], low[members[b]], exact)],
                                         ["query", "cid", "low", "score"])


def _first(rows: DataFrame, by: str, order: list, n: int, name: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return rows.withColumn(name, place).filter(F.col(name) <= n)


def nearest(vectors: DataFrame, is_query, *, k: int = 20, tables: int = 4, hashes: int = 5, width: float = 2.0, probes: int = 40,
            part_rows: int = 4096, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found for each row where ``is_query`` (a column of the id).

    Candidates are all rows but those with the query's own id, found through
    ``tables`` tables of ``hashes`` values, ``probes`` buckets each; a query
    that finds fewer than ``k`` is compared with every row.  Ties go to the
    smaller id.  Rows with a null id, or a vector that is null, empty, zero
    or holds null or non-finite components, take no part; vectors of other
    lengths than the query's are no candidates; a repeated row counts once.
    """
    good = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
            .filter(F.col("id").isNotNull() & usable("vec")))
    asks = F.coalesce(is_query(F.col("id")), F.lit(False))
    classes = written(good.groupBy("vec").agg(F.min("id").alias("low"), F.max(asks).alias("asks"))
                      .select("vec", "low", "asks", F.size("vec").alias("dim"), F.monotonically_increasing_id().alias("cid")), "vectors")
    members = written(good.join(classes.select("vec", "cid"), "vec").select("cid", "id").distinct(), "members")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    largest = {r[0]: r[1] for r in classes.groupBy("dim").agg(F.max(norm)).collect()}

    def make(dim, seen={}):  # noqa: B006  a worker's own
        if dim not in seen:
            seen[dim] = Tables(dim, tables, hashes, width)
        return seen[dim]

    base = classes.select("dim", "cid", "low", "vec")
    asked = classes.filter("asks").select("dim", "cid", "low", "vec")
    schema = f"dim int, slot int, bucket long, cid long, low long, vec {base.schema['vec'].dataType.simpleString()}"
    few = _first(members, "cid", ["id"], k + 1, PREFIX + "n").select("cid", "id")

    def best_rows(found):
        """The k + 1 best rows of each class of queries: its own row may be one of them."""
        top = _first(found.distinct(), "query", [F.col("score").desc(), "low"], k + 1, PREFIX + "n").select("query", "cid", "score")
        return _first(top.join(few, "cid"), "query", [F.col("score").desc(), "id"], k + 1, PREFIX + "n").select("query", "id", "score")

    found = _best(base.mapInArrow(_entries(make, None, largest), schema), asked.mapInArrow(_entries(make, probes, largest), schema), k + 1, part_rows)
    rows = written(best_rows(found), "nearest")
    enough = rows.groupBy("query").count().filter(F.col("count") > k)
    short = written(asked.join(enough, asked["cid"] == enough["query"], "left_anti"), "short")
    if not short.isEmpty():
        every = [t.withColumn("slot", F.lit(-1)).withColumn("bucket", F.lit(0).cast("long")) for t in (base, short)]
        rows = rows.join(short.select(F.col("cid").alias("query")), "query", "left_anti").unionByName(best_rows(_best(*every, k + 1, part_rows)))
    queries = members.filter(is_query(F.col("id"))).select(F.col("cid").alias("query"), F.col("id").alias("query_id"))
    ranked = _first(queries.join(rows, "query").filter(F.col("id") != F.col("query_id")), "query_id", [F.col("score").desc(), "id"], k, "rank")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
