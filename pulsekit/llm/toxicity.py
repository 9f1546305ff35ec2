"""Toxicity by a logistic classifier that is regularised with counterfactuals.

Features of a text are the words in it and their first 3 to 6 letters (so
inflected forms share what they begin with), present or not.  From a bounded
sample of labelled rows the features most associated with the label are
chosen by a chi-square count made in Spark, and weights are fitted to

    logistic loss + l2 |w|^2 / 2 + swap * mean (z(x) - z(x'))^2

where x' is a labelled text with its identity terms swapped for others of the
same kind.  A weight on a group's name alone changes z under the swap and is
driven to nothing, so a neutral mention does not raise the score; what is
said about the group is in both and keeps its weight.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import written
from pulsekit.llm.textchunks import ChunkTable, give_back, worker_table

#: Identity terms by kind; a term is swapped for the next of its kind (fixed values).
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "locals"), ("immigrant", "refugee", "foreigner", "local"),
    ("disabled", "deaf", "blind"), ("old", "young"),
)
_SWAP = {t: kind[(i + 1) % len(kind)] for kind in IDENTITY_TERMS for i, t in enumerate(kind)}
_WORD = re.compile(r"[^\W\d_]+")
THRESHOLD = 0.3


def chunk_features(chunk: str) -> list[str]:
    """Words of a lower-cased chunk, and their beginnings marked by ``^``."""
    out = []
    for word in _WORD.findall(chunk):
        out.append(word)
        out += ["^" + word[:k] for k in range(3, min(len(word), 7))]
    return out


def features(text: str) -> set[str]:
    return {f for c in set(text.lower().split()) for f in chunk_features(c)}


def swapped(text: str) -> str | None:
    """The text with its identity terms swapped, None without any."""
    low = text.lower()
    out = _WORD.sub(lambda m: _SWAP.get(m[0], m[0]), low)
    return out if out != low else None


@dataclass(frozen=True)
class Model:
    """Weights by feature; their number is bounded by ``fit``."""
    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def key(self) -> tuple:
        return ("toxicity", self.bias, hash(frozenset(self.weights.items())))


def fit(docs: DataFrame, labels: DataFrame, *, sample_rows: int = 16_000, max_features: int = 2_000, min_chi: float = 8.0,
        swap: float = 1.0, l2: float = 1e-3, rounds: int = 200, text_col: str = "text", id_col: str = "doc_id") -> Model:
    """A model from ``labels`` (``id_col``, ``toxic`` 0/1) on ``docs``.

    At most about ``sample_rows`` labelled rows are used, chosen by a hash of
    the id; up to that many it is all of them.  Several labels of one id count
    as the largest; null ids and labels are left out.  Without labels every
    score is a tenth, which no threshold of 0.3 reaches.
    """
    known = (labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").cast("int").alias("toxic")))
    share = min(1.0, sample_rows / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    sample = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                     .join(F.broadcast(chosen), "id")  # about sample_rows rows
                     .select("toxic", F.coalesce("text", F.lit("")).alias("text")), "toxicity-sample")
    n, pos = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < pos < n:
        return Model(float(np.log((pos + 0.1) / (n - pos + 0.9))))
    names = _choose(sample, n, pos, max_features, min_chi)
    rows = sample.mapInArrow(_vectors(names), "toxic int, row array<int>, swapped array<int>").toArrow()
    return _train(rows, names, swap, l2, rounds)


def _choose(sample: DataFrame, n: int, pos: int, max_features: int, min_chi: float) -> list[str]:
    """The features whose presence says most about the label, by the chi-square of the 2 x 2 table.

    Some features beyond ``min_chi`` are there by chance; the penalty on weights deals with those.
    """
    def counts(batches):
        seen: dict[str, list[int]] = {}
        for batch in batches:
            for y, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for f in features(text):
                    seen.setdefault(f, [0, 0])[y] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.string()), *(pa.array([c[y] for c in seen.values()], pa.int64()) for y in (0, 1))], ["f", "no", "yes"])

    total = sample.mapInArrow(counts, "f string, no long, yes long").groupBy("f").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    both = (F.col("yes") + F.col("no")).cast("double")
    off = F.col("yes") * n - both * pos
    chi = off * off * n / (both * (n - both) * pos * (n - pos))
    return [r.f for r in total.filter((both < n) & (chi >= min_chi)).orderBy(chi.desc(), "f").limit(max_features).collect()]


def _vectors(names: list[str]):
    index = {f: i for i, f in enumerate(names)}

    def row(text):
        return sorted(index[f] for f in features(text) if f in index)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            others = [swapped(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array([row(t) for t in texts], pa.list_(pa.int32())),
                 pa.array([None if t is None else row(t) for t in others], pa.list_(pa.int32()))], ["toxic", "row", "swapped"])

    return run


def _train(rows: pa.Table, names: list[str], swap: float, l2: float, rounds: int) -> Model:
    """Full-batch descent with per-weight step sizes; a few thousand weights, a bounded number of rows."""
    def sparse(lists):
        return np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.array([f for x in lists for f in x], dtype=np.int64)

    y = rows.column("toxic").to_numpy().astype(float)
    lists, other = rows.column("row").to_pylist(), rows.column("swapped").to_pylist()
    at, col = sparse(lists)
    changed = [i for i, x in enumerate(other) if x is not None and x != lists[i]]
    at_in, col_in = sparse([sorted(set(lists[i]) - set(other[i])) for i in changed])
    at_out, col_out = sparse([sorted(set(other[i]) - set(lists[i])) for i in changed])
    w, b = np.zeros(len(names)), float(np.log(y.mean() / (1 - y.mean())))
    grown, grown_b = np.full(len(names), 1e-8), 1e-8
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(b + np.bincount(at, w[col], len(y))))) - y
        g = np.bincount(col, error[at], len(w)) / len(y) + l2 * w
        if changed:
            shift = (np.bincount(at_in, w[col_in], len(changed)) - np.bincount(at_out, w[col_out], len(changed))) * 2 * swap / len(changed)
            g += np.bincount(col_in, shift[at_in], len(w)) - np.bincount(col_out, shift[at_out], len(w))
        grown += g * g
        grown_b += error.mean() ** 2
        w -= 0.3 * g / np.sqrt(grown)
        b -= 0.3 * error.mean() / np.sqrt(grown_b)
    return Model(float(b), {f: float(x) for f, x in zip(names, w, strict=True) if x})


def score(text: Column, model: Model) -> Column:
    """``double`` from 0 to 1 for a whole text; null and empty texts have the model's base rate."""
    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        def compute(chunk, known):
            return tuple(f for f in chunk_features(chunk) if f in model.weights)

        table = worker_table(model.key(), lambda: ChunkTable(compute, room=24 << 20))
        z = [model.bias + sum(sorted(model.weights[f] for f in set().union(*table.values(list(set((t or "").lower().split()))))))
             for t in texts.to_pylist()]
        give_back()
        return pa.array(1 / (1 + np.exp(-np.array(z, dtype=float))))

    return scores(text)
