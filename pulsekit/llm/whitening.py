"""Whitening of embeddings on their leading principal components.

The components come from Chebyshev-filtered subspace iteration: the only work
on rows is a pass that sends a block Q to XᵀXQ / n (X centred), summed over
the partitions; every small matrix (dimensions x block) lives on the driver.

1. A few Lanczos steps bound the spectrum from below.
2. Each round damps the part of the spectrum that is not wanted (from that
   bound to the least Ritz value of the block) by a Chebyshev polynomial,
   evaluated by its three-term recurrence, one pass a degree.
3. QR, then Rayleigh-Ritz in the block, whose own pass also gives the residuals.
4. Rounds end when every wanted pair is certified: its residual over the gap to
   the nearest other Ritz value bounds the angle to the true eigenvector.

The fit list (each distinct vector once) is a written table, so a lost executor costs a
re-read of its part.  Sums over partitions are made by Spark; the driver gets
one row for each entry of a block, whatever the number of rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.llm.common import PREFIX, written

_WHOLE = PREFIX + "x"
#: Whole numbers from here on do not fit a 64-bit integer.
_TOO_LARGE = float(1 << 63)


@dataclass
class Components:
    """Leading components of ``n`` vectors; the sums of their entries are exact."""

    n: int
    sums: list[int]
    vectors: np.ndarray      # a column each
    values: np.ndarray       # falling
    trace: float
    angles: np.ndarray       # certified bound on each component's error
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def fixed_point(vec: str, scale: int) -> Column:
    """floor(scale * c) of each entry as long; null for vectors that are null or hold an entry that is null, not finite or too large."""
    scaled = lambda c: c.cast("double") * F.lit(float(scale))
    fits = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(scaled(c)) < _TOO_LARGE))
    return F.when(F.coalesce(F.col(vec).isNotNull() & fits, F.lit(False)), F.transform(vec, lambda c: F.floor(scaled(c)).cast("long")))


def _matrices(batches, dim: int):
    """Whole-number matrices of the rows of Arrow batches."""
    for b in batches:
        if b.num_rows:
            yield b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dim)


def _total(fit: DataFrame, size: int, partial) -> np.ndarray:
    """The sum over partitions of ``partial(batches)``, a vector of ``size`` doubles each."""
    def run(batches):
        got = partial(batches)
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(size), pa.int32()), "v": pa.array(got, pa.float64())})

    rows = fit.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r["i"]] = r["v"]
    return out


def _covariance_times(fit: DataFrame, n: int, mean: np.ndarray):
    """Q -> XᵀXQ / n by one pass over the rows."""
    dim = len(mean)

    def apply(q: np.ndarray) -> np.ndarray:
        def partial(batches):
            got = np.zeros(q.shape)
            for x in _matrices(batches, dim):
                c = x - mean
                got += c.T @ (c @ q)
            return got.ravel()
        return _total(fit, q.size, partial).reshape(q.shape) / n
    return apply


def _lower_bound(apply, dim: int, rng, steps: int) -> float:
    """A bound below the spectrum: the least Ritz value of a few Lanczos steps less the last residual (0 at least)."""
    basis, alphas, betas = [], [], []
    v = rng.standard_normal(dim)
    v /= np.linalg.norm(v)
    for _ in range(min(steps, dim)):
        basis.append(v)
        w = apply(v[:, None])[:, 0]
        alphas.append(float(v @ w))
        for _twice in (0, 1):
            for b in basis:
                w = w - (b @ w) * b
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= 1e-12 * max(abs(alphas[0]), 1e-300):
            break
        v = w / betas[-1]
    t = np.diag(alphas) + np.diag(betas[:-1], 1) + np.diag(betas[:-1], -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - betas[-1])


def _filtered(apply, q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of ``degree`` that is small on [low, high], scaled to 1 at ``top``, times q."""
    centre, half = (high + low) / 2, (high - low) / 2
    sigma = first = half / (top - centre)
    before, now = q, (vq - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (apply(now) - centre * now) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return now


def _certified(values: np.ndarray, residuals: np.ndarray, wanted: int) -> np.ndarray:
    """Bounds on the sine of the angle between each wanted pair's vector and an eigenvector."""
    out = []
    for i in range(wanted):
        others = np.delete(values, i)
        gap = np.abs(others - values[i]).min() - residuals[i] if len(others) else np.inf
        out.append(residuals[i] / gap if gap > 0 else np.inf)
    return np.array(out)


def leading_components(fit: DataFrame, n: int, sums: list[int], k: int, block: int = 32, tolerance: float = 1e-12,
                       lanczos_steps: int = 10, rounds: int = 60, seed: int = 11) -> Components:
    """The ``k`` leading components of the rows of ``fit`` (one column, lists of longs of one length).

    Components whose value is zero to rounding are left out.  Rounds end when the
    certified angles are below ``tolerance``, or residuals at rounding level no
    longer fall (equal values have no vectors of their own; any basis of their
    space will do).
    """
    dim, passes = len(sums), 0
    mean = np.array([s / n for s in sums])
    times = _covariance_times(fit, n, mean)

    def apply(q):
        nonlocal passes
        passes += 1
        return times(q)

    def squares(batches):
        got = 0.0
        for x in _matrices(batches, dim):
            got += float(((x - mean) ** 2).sum())
        return np.array([got])

    trace = float(_total(fit, 1, squares)[0]) / n
    if trace <= 0:
        return Components(n, sums, np.zeros((dim, 0)), np.zeros(0), trace, np.zeros(0), passes)
    rng = np.random.default_rng([seed, dim])
    block = min(dim, max(block, 2 * k))
    low = _lower_bound(apply, dim, rng, lanczos_steps) if block < dim else 0.0
    q = np.linalg.qr(rng.standard_normal((dim, block)))[0]
    best = np.inf
    for _ in range(rounds):
        vq = apply(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        wanted = int((values[:k] > 1e-13 * dim * values[0]).sum())
        residuals = np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0)
        angles = _certified(values, residuals, wanted)
        worst = float(residuals.max()) / values[0]
        if block == dim or angles.max() <= tolerance or best < 1e-12 and worst > best / 2:
            break
        best = min(best, worst)
        top, high = values[0], values[-1]
        low_now = min(low, 0.999 * high)
        centre, half = (high + low_now) / 2, (high - low_now) / 2
        if half <= 1e-13 * top:         # nothing is left to damp: the rest is flat
            low_now, half, centre = 0.0, high / 2, high / 2
        if high <= 1e-13 * top:         # the block holds the whole range
            degree, low_now, high = 1, 0.0, max(high, 1e-13 * top)
        else:
            growth = math.acosh(max((values[wanted - 1] - centre) / half, 1 + 1e-9))
            degree = int(min(max(math.ceil(math.log(1e7) / growth), 2), 24))
        q = np.linalg.qr(_filtered(apply, q, vq, low_now, high, top, degree))[0]
    return Components(n, sums, q[:, :wanted], values[:wanted], trace, angles, passes)


def _exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Rows and the sums of each place, exact however large: sums of the upper and of the lower 32 bits."""
    x = F.col("x")
    parts = (fit.select(F.posexplode(_WHOLE).alias("i", "x"))
             .groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(x, 32)).alias("up"),
                               F.sum(x.bitwiseAND(F.lit((1 << 32) - 1))).alias("down")).orderBy("i").collect())
    return (parts[0]["n"] if parts else 0), [(r["up"] << 32) + r["down"] for r in parts]


def whiten(vectors: DataFrame, vec: str = "embedding", k: int = 4, scale: int = 256, **options) -> tuple[DataFrame, Components | None, float]:
    """``vectors`` with their places on the ``k`` leading components; the components; the identity error.

    Entries are taken as floor(scale * c).  Components are fitted on each
    distinct vector once.  Adds ``whitened`` (array, one entry a component)
    and ``deviation`` (sum over dimensions of (n x - S) ** 2, exact; null
    where it does not fit a long).

    Rows whose vector is null, empty, or holds an entry that is null, not
    finite or too large for a long are dropped, as are rows whose length is
    not the commonest of the table (of equally common ones, the largest).
    Repeated rows stay and count once in the fit.  Components of value zero
    do not exist (an empty table, a single vector, equal vectors have none;
    ``whitened`` is then empty or shorter).  The identity error is the largest
    absolute entry of the whitened fit list's covariance less the identity.
    Columns of the input that start with ``__pk_`` must not be there.
    """
    rows = vectors.withColumn(_WHOLE, fixed_point(vec, scale)).filter(F.size(_WHOLE) > 0)
    lengths = rows.groupBy(F.size(_WHOLE).alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        none = rows.select(*vectors.columns, F.array().cast("array<double>").alias("whitened"), F.lit(None).cast("long").alias("deviation"))
        return none, None, 0.0
    rows = rows.filter(F.size(_WHOLE) == lengths["dim"])
    fit = written(rows.select(_WHOLE).distinct(), "fit-list")
    n, sums = _exact_sums(fit)
    found = leading_components(fit, n, sums, k, **options)
    mean, dim = found.mean, len(sums)
    turn = found.vectors / np.sqrt(found.values) if len(found.values) else found.vectors
    m = turn.shape[1]

    def second_moments(batches):
        total, square = np.zeros(m), np.zeros((m, m))
        for x in _matrices(batches, dim):
            w = (x - mean) @ turn
            total += w.sum(axis=0)
            square += w.T @ w
        return np.concatenate([total, square.ravel()])

    error = 0.0
    if m:
        got = _total(fit, m + m * m, second_moments) / n
        error = float(np.abs(got[m:].reshape(m, m) - np.outer(got[:m], got[:m]) - np.eye(m)).max())

    def deviations(x: np.ndarray) -> list:
        wide = max(max(abs(n * int(x[:, d].max()) - s), abs(n * int(x[:, d].min()) - s)) for d, s in enumerate(sums))
        if dim * wide * wide < 1 << 63 and n * max(abs(int(x.max())), abs(int(x.min()))) < 1 << 63:
            away = x * n - np.array(sums, dtype=np.int64)
            return (away * away).sum(axis=1).tolist()
        exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x.tolist()]
        return [d if d < 1 << 63 else None for d in exact]

    def place(batches):
        for b in batches:
            at = b.schema.get_field_index(_WHOLE)
            x = b.column(at).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dim)
            w = (x - mean) @ turn
            lists = pa.ListArray.from_arrays(np.arange(b.num_rows + 1, dtype=np.int32) * m, pa.array(w.ravel(), pa.float64()))
            rest = [b.column(i) for i in range(b.num_columns) if i != at]
            names = [f for i, f in enumerate(b.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*rest, lists, pa.array(deviations(x) if len(x) else [], pa.int64())],
                                             [*names, PREFIX + "whitened", PREFIX + "deviation"])

    kept = [c for c in vectors.columns if c not in ("whitened", "deviation")]
    rows = rows.select(*kept, _WHOLE)
    schema = rows.drop(_WHOLE).schema.add(PREFIX + "whitened", T.ArrayType(T.DoubleType())).add(PREFIX + "deviation", T.LongType())
    out = rows.mapInArrow(place, schema).select(*kept, F.col(PREFIX + "whitened").alias("whitened"), F.col(PREFIX + "deviation").alias("deviation"))
    return out, found, error
