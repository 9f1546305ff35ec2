"""Vectors as the embedding operators take them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vec: str) -> Column:
    """Not null or empty, without null or non-finite components, not all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vec).isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of equal length as doubles."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A fixed orthonormal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner product of each pair of rows, summed in one order, so a pair has one value wherever it is computed."""
    return np.einsum("ij,ij->i", a, b)
