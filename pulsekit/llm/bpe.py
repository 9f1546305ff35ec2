"""Byte-level BPE: texts to ids and back, merges found by a segment tree.

A text is cut by the tokenizer's pattern; each match is merged alone.  Over
the byte positions of a match stands a segment tree whose leaf *i* holds the
rank of the pair that starts at *i* (if a live part starts there) and whose
nodes hold the smallest (rank, position) below, so the root is always the
leftmost pair of the lowest rank.  A merge changes three leaves, in
logarithmic time each: a match of n bytes takes O(n log n) steps, also when
it is a very long run without spaces.  Nodes have 16 children, so a usual word
is one node.
"""

from __future__ import annotations

import base64
import itertools
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsekit.llm.textchunks import ChunkTable, worker_table

_NONE = 1 << 62
_SHIFT = 32
_FAN = 16
_MASK = (1 << _SHIFT) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match.  A match that is itself a token is that token."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if not n:
        return []
    get = ranks.get
    leaves = [_NONE] * n
    for i in range(n - 1):
        r = get(piece[i:i + 2])
        if r is not None:
            leaves[i] = r << _SHIFT | i
    tree = [leaves]
    while len(tree[-1]) > _FAN:
        low = tree[-1]
        tree.append([min(low[i:i + _FAN]) for i in range(0, len(low), _FAN)])
    root, deep = tree[-1], len(tree) > 1
    ends = list(range(1, n + 1))        # where the live part that starts here ends
    before = list(range(-1, n - 1))     # start of the live part before it
    while (first := min(root)) < _NONE:
        i = first & _MASK
        j = ends[i]
        k = ends[j]
        ends[i] = k
        here = left = None
        if k < n:
            before[k] = i
            here = get(piece[i:ends[k]])
        p = before[i]
        if p >= 0:
            left = get(piece[p:k])
        leaves[j] = _NONE
        leaves[i] = _NONE if here is None else here << _SHIFT | i
        if p >= 0:
            leaves[p] = _NONE if left is None else left << _SHIFT | p
        if deep:
            for leaf in (p, i, j) if p >= 0 else (i, j):
                _raise(tree, leaf)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:ends[i]]])
        i = ends[i]
    return out


def _raise(tree: list[list[int]], at: int) -> None:
    """Renew the nodes above a changed leaf, as far up as they change."""
    for low, high in itertools.pairwise(tree):
        at //= _FAN
        least = min(low[at * _FAN:(at + 1) * _FAN])
        if high[at] == least:
            return
        high[at] = least


def _chunk_table(path: str, pattern: str) -> ChunkTable:
    def make():
        import regex

        ranks, find = load_ranks(path), regex.compile(pattern).findall

        def compute(chunk, known):
            out = []
            for piece in find(chunk):
                got = known(piece) if piece != chunk else None
                out.append(array("I", merge(piece.encode(), ranks)).tobytes() if got is None else got)
            return b"".join(out)

        return ChunkTable(compute)

    return worker_table(("bpe", path, pattern), make)


def encode_texts(texts: pa.Array, path: str, pattern: str):
    """Runs of ``array<int>``: the ids of each text (null: none)."""
    for found, at in _chunk_table(path, pattern).ids(texts):
        yield pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(found.view(np.int32)))


def decode_lists(rows: pa.ListArray, path: str) -> pa.Array:
    """The bytes that each list of ids stands for (null: null)."""
    token = _token_bytes(path)
    values = rows.values.to_numpy(zero_copy_only=False)
    return pa.array([b"".join([token[i] for i in values[a:b].tolist()]) if ok else None
                     for (a, b), ok in zip(itertools.pairwise(rows.offsets.to_numpy().tolist()), rows.is_valid().to_pylist(), strict=True)],
                    type=pa.binary())


def encode(text: Column, path: str, pattern: str) -> Column:
    """``array<int>`` of the ids of ``text`` by the rank file at ``path``.

    Null and empty texts give an empty array.  Texts are taken whole; special
    strings in them are ordinary text.
    """
    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield from encode_texts(texts, path, pattern)

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """``binary`` of the bytes that ``array<int>`` ids stand for (null: null).

    An id outside the rank file fails the query; it has no bytes.
    """
    @F.arrow_udf("binary")
    def data(rows: pa.Array) -> pa.Array:
        return decode_lists(rows, path)

    return data(ids)


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """``struct<ids: array<int>, decoded: binary>``: ``encode`` and ``decode`` of its ids, in one Python worker."""
    @F.arrow_udf("struct<ids: array<int>, decoded: binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for ids in encode_texts(texts, path, pattern):
                yield pa.StructArray.from_arrays([ids, decode_lists(ids, path)], ["ids", "decoded"])

    return both(text)


_BYTES: dict[str, dict[int, bytes]] = {}


def _token_bytes(path: str) -> dict[int, bytes]:
    if path not in _BYTES:
        _BYTES[path] = {i: b for b, i in load_ranks(path).items()}
    return _BYTES[path]
