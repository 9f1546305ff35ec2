"""Removal of byte strings that repeat across or inside documents, by suffix arrays.

A byte goes if it lies in a string of ``length`` bytes that starts anywhere
else too.  Finding these takes four steps, none of which brings a text or a
group of copies together in one task:

1. *Anchors.*  Every window of ``length`` bytes has an anchor: the leftmost
   smallest hash of a short gram in its first half.  It depends on nothing
   outside the window, and the ``length - half + 1`` bytes from the anchor on
   lie inside the window.  Windows with one anchor are consecutive.  Anchors
   whose bytes occur once in the corpus are dropped: their windows cannot
   repeat.
2. *Contexts.*  For the rest, the bytes that the anchor's windows cover are
   brought together by the anchor's bytes.  Equal contexts collapse before
   the shuffle, so a passage in very many documents is one row per batch.
3. *Suffix arrays.*  Of the contexts that meet, the parts right of the anchor
   and, reversed, the parts left of it are cut into blocks and sorted by
   suffix arrays of the blocks (linear grouping), with the bytes that
   neighbours share.  A window repeats if another context shares its bytes on
   both sides: for each distance to the anchor, contexts equal on the left
   are runs of the left order, and their nearest in the right order shares
   the most on the right.
4. *Cutting.*  The windows found go back to where their contexts occur, are
   merged per document, and the text between them is kept.

An anchor whose distinct contexts are too many for one task is not sorted;
its windows are compared by equality joins of 128-bit digests.

``repeats(words=...)`` looks for passages of words in the same sweep: words
are hashed, windows of words have anchors as windows of bytes do, and of the
anchors that repeat the windows' digests, not their words, are brought
together.  Texts are joined with the places of both kinds once.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import PREFIX, written
from pulsekit.llm.suffix_array import suffix_array
from pulsekit.llm.textchunks import forget, give_back
from pulsekit.llm.tiles import gathered, whole_groups

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_BLOCK = 64


class Windows:
    """Anchors of all windows of ``length`` bytes."""

    def __init__(self, length: int, gram: int | None = None, half: int | None = None):
        self.length = length
        self.gram = gram or max(1, min(16, length // 4))
        self.half = half or max(1, (length - self.gram + 1) // 2)
        self.core = length - self.half + 1
        if self.half > _SPAN:
            raise ValueError(f"windows of {length} bytes: an anchor may lie over {_SPAN} bytes into its window")

    def anchors(self, data: np.ndarray, at: np.ndarray):
        """Of texts in a row that begin at ``at`` (and end): text, first and last window, anchor, hash of the anchor's bytes."""
        return self.anchors_of(_TABLE[data], at)

    def anchors_of(self, letters: np.ndarray, at: np.ndarray):
        """:meth:`anchors` of texts whose letters, bytes or words, are given by their hashes."""
        n = len(letters)
        none = np.zeros(0, dtype=np.int64)
        valid = np.zeros(n + 1, dtype=np.int64)
        long = np.flatnonzero(np.diff(at) >= self.length)
        if not len(long):
            return none, none, none, none, none
        np.add.at(valid, at[long], 1)
        np.add.at(valid, at[long + 1] - self.length + 1, -1)
        windows = np.flatnonzero(np.cumsum(valid[:-1]))
        grams = _folded(letters, self.gram, lambda a, b, k: a * np.uint64(pow(_BASE, k, 1 << 64)) + b)
        ranked = _mixed(grams) >> np.uint64(32) << np.uint64(32) | np.arange(len(grams), dtype=np.uint64)
        least = _folded(ranked, self.half, lambda a, b, k: np.minimum(a, b))
        owner = (least[windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.concatenate([[True], (owner[1:] != owner[:-1]) | (np.diff(windows) != 1)])
        last = np.append(first[1:], True)
        anchor = owner[first]
        through = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(letters * _powers(n, _BASE))])
        # the sums are weighted by place; undone by the inverse power, equal strings are equal wherever they are
        key = _mixed((through[anchor + self.core] - through[anchor]) * _powers(n, _INVERSE)[anchor])
        lo = windows[first]
        return np.searchsorted(at, lo, side="right") - 1, lo, windows[last], anchor, key.view(np.int64)


def word_windows(words: int) -> Windows:
    """Anchors of all windows of ``words`` words: pairs of words in the first two thirds, so that they are few."""
    gram = min(2, words)
    return Windows(words, gram, max(1, min(words - gram + 1, 2 * words // 3)))


_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """Powers 0 to n - 1 of an odd number, modulo 2^64."""
    if len(_POWERS.get(base, ())) < n:
        _POWERS[base] = np.cumprod(np.concatenate([np.ones(1, dtype=np.uint64), np.full(max(n, 1 << 21), base, dtype=np.uint64)]))
    return _POWERS[base][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ x >> np.uint64(29)


def _folded(x: np.ndarray, count: int, join) -> np.ndarray:
    """``join`` over each run of ``count`` items, by doubling; shorter by ``count - 1``.  ``join(a, b, items in b)``."""
    out, have, part, size = None, 0, x, 1
    while True:
        if count & size:
            if out is None:
                out, have = part, size
            else:
                m = len(x) - have - size + 1
                out = join(out[:max(m, 0)], part[have:have + max(m, 0)], size)
                have += size
        size *= 2
        if size > count:
            return out
        part = join(part[:len(part) - size // 2], part[size // 2:], size // 2)


def _runs(batch: pa.RecordBatch, limit: int = 1 << 18):
    """Slices of a batch of about ``limit`` bytes of text: the slice, its bytes, and where each text begins."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // limit)) + 1).tolist(), batch.num_rows]
    for a, b in itertools.pairwise(cuts):
        if b > a:
            texts = pc.fill_null(batch.column("text").slice(a, b - a).cast(pa.binary()), b"")
            yield batch.slice(a, b - a), np.frombuffer(b"".join(texts.to_pylist()), dtype=np.uint8), np.concatenate([[0], np.cumsum(sizes[a:b])])


_PLACE = 1 << 31                # more than a text's bytes
_SPAN = 1 << 16                 # more than the bytes from a window's start to its anchor; a place and two spans fill 63 bits


def _pieces(data: np.ndarray, at: np.ndarray, length: int, limit: int):
    """Texts in a row; if one is longer than ``limit``, text by text, such ones in pieces that overlap by a window less a byte.

    Yields bytes, where texts begin in them, the number of the first text, and the bytes of it before these.
    """
    if np.diff(at).max(initial=0) <= limit:
        yield data, at, 0, 0
        return
    for t, (begin, end) in enumerate(itertools.pairwise(at.tolist())):
        for first in range(0, max(1, end - begin - length + 1), limit):
            piece = data[begin + first:min(end, begin + first + limit + length - 1)]
            yield piece, np.array([0, len(piece)]), t, first


def _candidates(windows: Windows, limit: int = 1 << 20, passages: Windows | None = None):
    """(deal, known, row, place) of every anchor; texts of more than ``limit`` bytes are searched in pieces.

    ``passages``: windows of words whose anchors follow, ``coded``.

    Of equal anchors in one batch one row is dealt by the anchor's hash, so
    that others learn of it; the rest are known to repeat and go anywhere.
    """
    def run(batches):
        forget()
        for batch in batches:
            parts, coded = [], []
            for some, whole, starts in _runs(batch):
                rows = some.column("row").to_numpy()
                for data, at, first, before in _pieces(whole, starts, windows.length, limit):
                    text, lo, hi, anchor, key = windows.anchors(data, at)
                    parts.append((key, rows[text + first], _packed(anchor, lo, hi, at[text] - before)))
                if passages:
                    hashes, at = _word_hashes(whole, starts)
                    text, lo, hi, anchor, key = passages.anchors_of(hashes, at)
                    coded.append((~key, rows[text], _packed(anchor, lo, hi, at[text])))
            for some, kind in ((parts, False), (coded, True)):
                if some:
                    yield _asking(some, kind)
        give_back()

    return run


def _packed(anchor, lo, hi, start):
    """An anchor's place in its text with the distances from its first and last window to it."""
    return (anchor - start) + _PLACE * ((anchor - lo) + _SPAN * (anchor - hi))


def _asking(parts: list[tuple], coded: bool) -> pa.RecordBatch:
    key, row, place = (np.concatenate(x) for x in zip(*parts, strict=True))
    _, first, back, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    known = count[back] > 1
    alone = np.zeros(len(key), dtype=bool)
    alone[first] = True
    deal = np.where(alone, key, _mixed(row.view(np.uint64)).view(np.int64))
    columns = (deal, known, alone, row, place, np.full(len(key), coded))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["deal", "known", "asks", "row", "place", "coded"])


def _repeated(batches):
    """Anchors whose bytes occur again: rows come sorted by hash, so a neighbour is enough."""
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if held is not None:
            t = pa.concat_tables([held, t])
        if not t.num_rows:
            continue
        # the last asking row waits for what follows
        yield from _decided(t, final=False)
        held = _kept(t)
    if held is not None:
        yield from _decided(held, final=True)


def _marks(t: pa.Table):
    deal, known, asks = (t.column(c).to_numpy() for c in ("deal", "known", "asks"))
    where = np.flatnonzero(asks)
    same = deal[where][1:] == deal[where][:-1]
    again = known.copy()
    again[where[1:][same]] = True
    again[where[:-1][same]] = True
    return again, where


def _kept(t: pa.Table) -> pa.Table | None:
    """The last asking row, marked known if an earlier one was equal."""
    again, where = _marks(t)
    if not len(where):
        return None
    last = t.slice(int(where[-1]), 1)
    return last.set_column(t.column_names.index("known"), "known", pa.chunked_array([pa.array([bool(again[where[-1]])])]))


def _decided(t: pa.Table, final: bool):
    again, where = _marks(t)
    if not final and len(where):
        again = again.copy()
        again[where[-1]] = False
    if again.any():
        out = t.filter(pa.array(again)).select(["row", "place", "coded"])
        yield from out.to_batches()


def _slices(batch: pa.RecordBatch, limit: int = 4 << 20):
    """Slices of a batch of about ``limit`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // limit)) + 1).tolist(), batch.num_rows]
    for a, b in itertools.pairwise(cuts):
        if b > a:
            yield batch.slice(a, b - a)


def _found_contexts(windows: Windows, some: pa.RecordBatch):
    """(digest, bytes before the anchor, bytes after it that no window begins at, row, text, anchor) of each place of documents (row, text, places)."""
    import xxhash

    for row, text, found in zip(some.column("row").to_pylist(), some.column("text").cast(pa.binary()).to_pylist(),
                                some.column("places").to_pylist(), strict=True):
        for place in found:
            anchor, spans = place % _PLACE, place // _PLACE
            left, right = spans % _SPAN, spans // _SPAN
            context = text[anchor - left:anchor - right + windows.length]
            if anchor < left or len(context) < left - right + windows.length:
                continue  # another row's place, by an equal row hash
            digest = xxhash.xxh3_128_intdigest(context)
            yield ((digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63), left), left - right + 1, row, context, anchor


def _places(windows: Windows):
    """Where contexts occur."""
    def run(batches):
        for batch in batches:
            for some in _slices(batch):
                rows = [(*name, row, anchor - name[2]) for name, _, row, _, anchor in _found_contexts(windows, some)]
                if rows:
                    yield _batch(rows, _PLACES)
        give_back()

    return run


def _contexts(windows: Windows, keys_only: bool = False, bytes_once: bool = False, limit: int = 8 << 20):
    """Contexts with their bytes, in batches of about ``limit`` of these; equal ones of a batch are one row.

    ``bytes_once``: one that comes again in a later batch of a task has its number, not its bytes.
    """
    import xxhash

    def run(batches):
        for batch in batches:
            rows: dict[tuple, list] = {}
            size, sent = 0, set()
            for some in _slices(batch):
                for name, n, _, context, anchor in _found_contexts(windows, some):
                    got = rows.get(name)
                    if got is not None:
                        got[5] = 2
                        continue
                    left = name[2]
                    key = xxhash.xxh64_intdigest(context[left:left + windows.core]) - (1 << 63)
                    held = b"" if keys_only or (bytes_once and name in sent) else context
                    rows[name] = [key, *name, n, 1, held]
                    size += len(held) + 100
                    if size >= limit:
                        yield _batch(list(rows.values()), _CONTEXTS)
                        sent.update(rows)
                        rows, size = {}, 0
            if rows:
                yield _batch(list(rows.values()), _CONTEXTS)
        give_back()

    return run


_CONTEXTS = "key long, c1 long, c2 long, lead int, n int, times int, context binary"
_PLACES = "c1 long, c2 long, lead int, row long, first long"
_FOUND = "c1 long, c2 long, lead int, a int, b int"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _batch(rows: list, schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)],
                                      [f for f, _ in fields])


def _repeats(windows: Windows, part: int = 20_000):
    """Contexts sorted by anchor: the runs of their windows that repeat, as first and last window.

    About ``part`` contexts are sorted at a time, but never less than an anchor's.
    """
    def run(batches):
        for t, cuts in whole_groups(batches, ["key"]):
            contexts, lead, n, times, names = _collapsed(t)
            if not len(lead):
                continue
            again = np.zeros((len(lead), int(n.max())), dtype=bool)
            again[times > 1] = True
            group = names[:, 0]
            met = np.concatenate([[False], group[1:] == group[:-1]])
            met[:-1] |= met[1:].copy()
            some = np.flatnonzero(met)
            for mine in _whole_parts(some, group[some], part):
                found = shared_windows([contexts[i] for i in mine.tolist()], lead[mine], n[mine], windows.length)[:, :again.shape[1]]
                again[mine, :found.shape[1]] |= found
            again &= np.arange(again.shape[1]) < n[:, None]
            yield from _as_runs(again, names)
        give_back()

    return run


def _whole_parts(rows: np.ndarray, group: np.ndarray, limit: int) -> list[np.ndarray]:
    """``rows`` in parts of at most ``limit``, cut only where ``group`` changes; a larger group is a part of its own."""
    ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(rows)).tolist()
    cuts = [0]
    for begin, end in itertools.pairwise([0, *ends]):
        if end - cuts[-1] > limit and begin > cuts[-1]:
            cuts.append(begin)
    return [rows[a:b] for a, b in itertools.pairwise([*cuts, len(rows)]) if b > a]


def _collapsed(t: pa.Table):
    """Distinct contexts of a table sorted by key, with how often they occur (2: or more)."""
    columns = [t.column(c).to_numpy() for c in ("key", "c1", "c2", "lead")]
    no_bytes = pc.equal(pc.binary_length(t.column("context")), 0).to_numpy()
    order = np.lexsort([no_bytes, *columns[::-1]])
    key, c1, c2, lead = (c[order] for c in columns)
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1]) | (lead[1:] != lead[:-1])])
    start = np.flatnonzero(new)
    times = np.add.reduceat(t.column("times").to_numpy()[order], start)
    picked = order[start]
    contexts = t.column("context").take(pa.array(picked)).to_pylist()
    return contexts, lead[start].astype(np.int64), t.column("n").to_numpy()[picked].astype(np.int64), times, np.stack([key[start], c1[start], c2[start], lead[start]], axis=1)


def _as_runs(again: np.ndarray, names: np.ndarray):
    padded = np.zeros((len(again), again.shape[1] + 2), dtype=np.int8)
    padded[:, 1:-1] = again
    row, a = np.nonzero(np.diff(padded, axis=1) == 1)
    _, b = np.nonzero(np.diff(padded, axis=1) == -1)
    if len(row):
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[row, 1]), pa.array(names[row, 2]), pa.array(names[row, 3].astype(np.int32)), pa.array(a.astype(np.int32)),
             pa.array((b - 1).astype(np.int32))], ["c1", "c2", "lead", "a", "b"])


def _padded(parts: list[bytes], width: int) -> np.ndarray:
    """Rows of bytes plus one (no byte of UTF-8 is 255), filled with zeros."""
    out = np.zeros((len(parts), width), dtype=np.uint8)
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    where = np.arange(width) < sizes[:, None]
    out[where] = np.frombuffer(b"".join(parts), dtype=np.uint8) + 1
    return out


def _sorted_parts(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of some strings, and how many bytes each shares with the one before it (the first: 0).

    The strings are cut into blocks; blocks are the symbols of one text, with
    a mark after each string, whose suffix array holds the strings' order.
    """
    width = max(1, -(-max(map(len, parts)) // _BLOCK)) * _BLOCK
    rows = _padded(parts, width)
    blocks = rows.reshape(-1, _BLOCK)
    _, symbol = np.unique(np.ascontiguousarray(blocks).view(f"S{_BLOCK}").ravel(), return_inverse=True)
    grid = np.full((len(parts), width // _BLOCK + 1), -1, dtype=np.int64)
    grid[:, :-1] = symbol.reshape(len(parts), -1)
    grid[:, -1] = -1
    array = np.array(suffix_array((grid.ravel() + 1).tolist()))
    starts = array[array % grid.shape[1] == 0]
    order = starts // grid.shape[1]
    differ = rows[order[1:]] != rows[order[:-1]]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    sizes = np.array([len(p) for p in parts])
    shared = np.minimum(shared, np.minimum(sizes[order[1:]], sizes[order[:-1]]))
    return order, np.concatenate([[0], shared])


def _range_minima(x: np.ndarray):
    """``least(a, b)``: the smallest of x[a..b] for arrays a <= b."""
    table = [x]
    while 2 << len(table) - 1 <= len(x):
        half = 1 << len(table) - 1
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))

    def least(a, b):
        level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), dtype=x.dtype)
        for k in np.unique(level):
            on = level == k
            out[on] = np.minimum(table[k][a[on]], table[k][b[on] - (1 << int(k)) + 1])
        return out

    return least


def shared_windows(contexts: list[bytes], lead: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """Which of the windows of each context occur in another of these contexts at the same distance from the anchor.

    Context i has its anchor after ``lead[i]`` bytes and ``n[i]`` windows,
    the first at its first byte.  Windows that begin after the anchor do not occur.
    """
    leads = lead.tolist()
    right, right_shared = _sorted_parts([c[k:] for c, k in zip(contexts, leads, strict=True)])
    left, left_shared = _sorted_parts([c[:k][::-1] for c, k in zip(contexts, leads, strict=True)])
    rank = np.empty(len(contexts), dtype=np.int64)
    rank[right] = np.arange(len(contexts))
    least = _range_minima(right_shared)
    out = np.zeros((len(contexts), int(max(n.max(), (lead + 1).max()))), dtype=bool)
    for before in range(int(lead.max()) + 1):
        has = (lead >= before) & (lead - before < n)
        kind = np.cumsum(left_shared < before)
        rows = left[has[left]]
        if len(rows) < 2:
            continue
        kinds = kind[has[left]]
        order = np.lexsort((rank[rows], kinds))
        rows, kinds = rows[order], kinds[order]
        pair = np.flatnonzero(kinds[1:] == kinds[:-1])
        if not len(pair):
            continue
        same = least(rank[rows[pair]] + 1, rank[rows[pair + 1]]) + before >= length
        for some in (rows[pair[same]], rows[pair[same] + 1]):
            out[some, lead[some] - before] = True
    return out


def _by_digest(windows: Windows):
    """Contexts of crowded anchors: one row per window, with a digest of its bytes."""
    import xxhash

    def run(batches):
        for batch in batches:
            rows = []
            for c1, c2, lead, n, times, context in zip(*(batch.column(c).to_pylist() for c in ("c1", "c2", "lead", "n", "times", "context")), strict=True):
                for s in range(n):
                    digest = xxhash.xxh3_128_intdigest(context[s:s + windows.length])
                    rows.append((c1, c2, lead, s, times, (digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63)))
            if rows:
                yield _batch(rows, _DIGESTS)

    return run


_DIGESTS = "c1 long, c2 long, lead int, a int, times int, d1 long, d2 long"


def _by_anchor(found_in, contexts, places, schema: str, repeats, by_digest, crowded: int, length: int) -> DataFrame:
    """(row, spans) of the windows that repeat.

    ``found_in(step, schema)`` applies steps to the documents with candidates:
    ``contexts(keys_only, bytes_once)`` gives contexts of ``schema``,
    ``places`` where they occur.  ``repeats`` takes contexts sorted by anchor;
    ``by_digest`` gives the windows, with a digest (d1, d2) each, of those of
    anchors with more than ``crowded`` contexts.
    """
    busy = written(found_in(contexts(True, False), schema).groupBy("key").count()
                   .filter(F.col("count") > crowded).select("key"), "crowded", free=True)
    none = busy.isEmpty()
    all_contexts = found_in(contexts(False, none), schema)
    if none:
        found = gathered(all_contexts, ["key"]).mapInArrow(repeats, _FOUND)
    else:
        name = ["c1", "c2", "lead", "a"]
        each = by_digest(all_contexts.join(busy, "key"))
        twice = each.groupBy("d1", "d2").agg(F.sum("times").alias("all")).filter(F.col("all") > 1)
        met = each.join(twice, ["d1", "d2"]).select(*name, F.col("a").alias("b")).distinct()
        found = (gathered(all_contexts.join(busy, "key", "left_anti"), ["key"]).mapInArrow(repeats, _FOUND)
                 .unionByName(met))
    spans = (found_in(places, _PLACES).join(found, ["c1", "c2", "lead"])
             .select("row", F.struct((F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b") + length).alias("b")).alias("s"))
             .groupBy("row").agg(F.sort_array(F.collect_set("s")).alias("spans")))
    return spans.mapInArrow(_merged, "row long, spans array<struct<a:long,b:long>>")


def repeated_windows(docs: DataFrame, length: int = 400, crowded: int = 50_000, code=None, piece: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """Of ``docs`` (row: a hash that names it, text): (row, text) of those with candidates, and (row, spans) of bytes that repeat.

    ``code``: what turns batches of (row, text) into those to search, within the same Python worker.

    ``spans``: sorted, disjoint, not touching [first, end) byte ranges.
    """
    return _repeated_windows(docs, length, None, crowded, code, piece)[:2]


def windows_and_passages(docs: DataFrame, length: int, words: int, crowded: int = 50_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """:func:`repeated_windows` and (row, spans) as :func:`repeated_passages` gives them, in one sweep over the texts."""
    return _repeated_windows(docs, length, words, crowded)


def _repeated_windows(docs: DataFrame, length: int, words: int | None, crowded: int, code=None, piece: int = 1 << 20):
    windows, passages = Windows(length), word_windows(words) if words else None
    candidates = _candidates(windows, piece, passages)
    dealt = docs.select("row", "text").mapInArrow(lambda batches: candidates(code(batches) if code else batches),
                                                  "deal long, known boolean, asks boolean, row long, place long, coded boolean")
    again = gathered(dealt, ["deal"]).mapInArrow(_repeated, "row long, place long, coded boolean")
    kinds = {"places": ~F.col("coded")} | ({"passages": F.col("coded")} if words else {})
    places = again.groupBy("row").agg(*(F.collect_set(F.when(c, F.col("place"))).alias(k) for k, c in kinds.items()))  # bounded by the text's length
    affected = written(docs.select("row", "text").join(places, "row"), "repeats", free=True)  # not coded: texts take less room than codes

    def found_in(kind):
        some = affected.filter(F.size(kind) > 0).select("row", "text", kind)
        return lambda step, schema: some.mapInArrow(lambda batches: step(code(batches) if code else batches), schema)

    spans = _by_anchor(found_in("places"), lambda keys_only, once: _contexts(windows, keys_only, once), _places(windows), _CONTEXTS,
                       _repeats(windows), lambda some: some.mapInArrow(_by_digest(windows), _DIGESTS), crowded, length)
    texts = affected.select("row", "text")
    if not words:
        return texts, spans
    runs = _by_anchor(found_in("passages"), lambda keys_only, _: _passage_contexts(passages, keys_only), _passage_places(passages), _PASSAGES,
                      _repeated_passages, _passage_windows, crowded, words)
    coded = F.transform("spans", lambda s: F.struct((s["a"] * _WIDTH).alias("a"), (s["b"] * _WIDTH).alias("b")))
    # one kind's contexts are gone before the other's come
    return texts, written(spans, "spans", free=True), written(runs.select("row", coded.alias("spans")), "passages", free=True)


def _found_passages(windows: Windows, some: pa.RecordBatch):
    """Of the places of documents (row, text, passages): anchor's hash, digest of all words, words before the anchor, windows, row and
    first word of each, and where its windows begin in the digests of all windows of these texts, the last."""
    texts = some.column("text").cast(pa.binary()).to_pylist()
    hashes, at = _word_hashes(np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)]))
    lists = some.column("passages")
    text = np.repeat(np.arange(some.num_rows), lists.value_lengths().to_numpy())
    place = lists.flatten().to_numpy()
    anchor, spans = place % _PLACE, place // _PLACE
    left, n = spans % _SPAN, spans % _SPAN - spans // _SPAN + 1
    mine = (anchor >= left) & (at[text] + anchor - left + n - 1 + windows.length <= at[text + 1])  # else another row's place, by an equal row hash
    text, anchor, left, n = (x[mine] for x in (text, anchor, left, n))
    lo = at[text] + anchor - left
    through = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * _powers(len(hashes), _BASE))])
    undone = _powers(len(hashes) + 1, _INVERSE)

    def digest(a, count):
        return _mixed((through[a + count] - through[a]) * undone[a]).view(np.int64)

    every = digest(np.arange(max(0, len(hashes) - windows.length + 1)), windows.length)
    return digest(lo + left, windows.core), digest(lo, n - 1 + windows.length), left, n, some.column("row").to_numpy()[text], anchor - left, lo, every


_PASSAGES = "key long, c1 long, c2 long, lead int, times int, windows array<long>"


def _passage_contexts(windows: Windows, keys_only: bool):
    """Contexts of words: the digests of their windows; equal ones of a slice of a batch are one row."""
    def run(batches):
        for batch in batches:
            for some in _slices(batch):
                key, whole, left, n, _, _, lo, every = _found_passages(windows, some)
                name = _mixed(_mixed(key.view(np.uint64)) ^ whole.view(np.uint64) + left.astype(np.uint64))
                _, first, times = np.unique(name, return_index=True, return_counts=True)
                held = np.zeros(len(first), dtype=np.int64) if keys_only else n[first]
                ends = np.concatenate([[0], np.cumsum(held)])
                values = every[np.repeat(lo[first] - ends[:-1], held) + np.arange(ends[-1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[first]), pa.array(key[first]), pa.array(whole[first]), pa.array(left[first].astype(np.int32)),
                     pa.array(np.minimum(times, 2).astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))],
                    ["key", "c1", "c2", "lead", "times", "windows"])
        give_back()

    return run


def _passage_places(windows: Windows):
    """Where contexts of words occur."""
    def run(batches):
        for batch in batches:
            for some in _slices(batch):
                key, whole, left, _, row, first, _, _ = _found_passages(windows, some)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, whole, left.astype(np.int32), row, first)], ["c1", "c2", "lead", "row", "first"])
        give_back()

    return run


def _repeated_passages(batches):
    """Contexts of words sorted by anchor: the runs of their windows that repeat, as first and last window.

    Equal windows have one anchor at one distance, so a context holds no window twice.
    """
    for t, _ in whole_groups(batches, ["key"]):
        key, c2, lead = (t.column(c).to_numpy() for c in ("key", "c2", "lead"))
        order = np.lexsort((lead, c2, key))
        key, c2, lead = key[order], c2[order], lead[order]
        start = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (c2[1:] != c2[:-1]) | (lead[1:] != lead[:-1])]))
        times = np.add.reduceat(t.column("times").to_numpy()[order], start)
        lists = t.column("windows").combine_chunks().take(pa.array(order[start]))
        n = lists.value_lengths().to_numpy()
        context, windows = np.repeat(np.arange(len(start)), n), lists.flatten().to_numpy()
        by = np.lexsort((windows, key[start][context]))
        sorted_key, sorted_window = key[start][context][by], windows[by]
        new = np.concatenate([[True], (sorted_key[1:] != sorted_key[:-1]) | (sorted_window[1:] != sorted_window[:-1])])
        again = np.empty(len(windows), dtype=bool)
        again[by] = (np.add.reduceat(times[context][by], np.flatnonzero(new)) > 1)[np.cumsum(new) - 1]
        edge = np.concatenate([[True], context[1:] != context[:-1]])
        begin = np.flatnonzero(again & (edge | ~np.concatenate([[False], again[:-1]])))
        end = np.flatnonzero(again & (np.append(edge[1:], True) | ~np.append(again[1:], False)))
        at = np.flatnonzero(edge)[context[begin]]
        where = start[context[begin]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[where]), pa.array(c2[where]), pa.array(lead[where]), pa.array((begin - at).astype(np.int32)), pa.array((end - at).astype(np.int32))],
            ["c1", "c2", "lead", "a", "b"])


def _passage_windows(contexts: DataFrame) -> DataFrame:
    """Contexts of words of crowded anchors: one row per window."""
    return contexts.select("c1", "c2", "lead", "times", F.posexplode("windows").alias("a", "d2")).withColumn("d1", F.col("c1"))


def _merged(batches):
    for batch in batches:
        out = []
        for spans in batch.column("spans").to_pylist():
            merged: list[dict] = []
            for s in spans:
                if merged and s["a"] <= merged[-1]["b"]:
                    merged[-1]["b"] = max(merged[-1]["b"], s["b"])
                else:
                    merged.append(s)
            out.append(merged)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))], ["row", "spans"])


_WIDTH = 8


def _word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word of texts in a row that begin at ``at`` (and end); words stand between Unicode's spaces."""
    space = np.zeros(len(data) + 1, dtype=bool)
    space[:-1] = _SPACE[data]
    for lead, wides in _WIDE_SPACES.items():
        where = np.flatnonzero(data == lead)
        for wide in wides:
            hit = where[where + len(wide) <= len(data)]
            for k, byte in enumerate(wide):
                hit = hit[data[hit + k] == byte]
            for k in range(len(wide)):
                space[hit + k] = True
    word = ~space
    word[-1] = False
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[at] = True
    before = np.concatenate([[False], word[:-1]])
    return np.flatnonzero(word & (cut | ~before)), np.flatnonzero(before & (cut | ~word))


_SPACE = np.isin(np.arange(256), np.frombuffer(b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f ", dtype=np.uint8))
_WIDE_SPACES: dict[int, list[bytes]] = {}
for _c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
    _WIDE_SPACES.setdefault(chr(_c).encode()[0], []).append(chr(_c).encode())


def _word_hashes(data: np.ndarray, at: np.ndarray, limit: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts in a row that begin at ``at`` (and end), and where each text's words begin (and end); about ``limit`` bytes at a time."""
    begin, end = _word_bounds(data, at)
    out = np.empty(len(begin), dtype=np.uint64)
    cuts = np.flatnonzero(np.diff(begin // limit)) + 1
    for a, b in itertools.pairwise([0, *cuts.tolist(), len(begin)]):
        if b > a:
            some, first, last = data[begin[a]:end[b - 1]], begin[a:b] - begin[a], end[a:b] - begin[a]
            through = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_TABLE[some] * _powers(len(some), _BASE))])
            out[a:b] = _mixed((through[last] - through[first]) * _powers(len(some) + 1, _INVERSE)[first])
    return out, np.searchsorted(begin, at)


def _as_words(batches):
    """Texts with each word as ``_WIDTH`` bytes of its hash (none is 255), without what stands between words; other columns stay."""
    for batch in batches:
        for some, data, at in _runs(batch):
            begin, end = _word_bounds(data, at)
            through = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_TABLE[data] * _powers(len(data), _BASE))])
            words = _mixed((through[end] - through[begin]) * _powers(len(data) + 1, _INVERSE)[begin]) & np.uint64(0x7F7F7F7F7F7F7F7F)
            edges = (np.searchsorted(begin, at) * _WIDTH).tolist()
            coded = words.astype("<u8").tobytes()
            texts = pa.array([coded[a:b] for a, b in itertools.pairwise(edges)], pa.binary())
            yield pa.RecordBatch.from_arrays([texts if c == "text" else some.column(c) for c in some.schema.names], some.schema.names)


def repeated_passages(docs: DataFrame, words: int) -> DataFrame:
    """Of ``docs`` (row: a hash that names it, text): (row, spans) of words that lie in ``words`` words in a row that repeat.

    ``spans``: as :func:`repeated_windows` gives them for the words' hashes,
    ``_WIDTH`` bytes a word.  Words are equal whatever space stands between them.
    """
    return repeated_windows(docs, words * _WIDTH, code=_as_words)[1]


def _united(text: memoryview, spans: list | None, passages: list | None) -> list:
    """Sorted, disjoint byte spans: ``spans`` and, from first to last whole word, ``passages``."""
    if not passages:
        return spans or []
    begin, end = _word_bounds(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]))
    # hashes of the words next to a passage may share some bytes
    whole = [(-(-r["a"] // _WIDTH), r["b"] // _WIDTH) for r in passages]
    both = [*(spans or []), *({"a": int(begin[a]), "b": int(end[b - 1])} for a, b in whole)]
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    return next(_merged([pa.RecordBatch.from_arrays(
        [pa.array([0]), pa.array([sorted(both, key=lambda s: (s["a"], s["b"]))], kind)], ["row", "spans"])])).column("spans")[0].as_py()


def _cut(text, spans: list | None, passages: list | None = None) -> bytes:
    """The bytes of a text (an Arrow scalar) outside spans and passages (null text: none)."""
    data = text.as_buffer()
    t = memoryview(data) if data is not None else memoryview(b"")
    edges = [0, *(e for s in _united(t, spans, passages) for e in (s["a"], s["b"])), len(t)]
    return b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def kept_bytes(text, spans) -> F.Column:
    """``binary``: the bytes of a text outside ``spans`` (null: all; null text: none)."""
    @F.arrow_udf("binary")
    def kept(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            yield pa.array([_cut(texts[i], s) for i, s in enumerate(lists.to_pylist())], type=pa.binary())
            give_back()

    return kept(text, spans)


def kept_parts(text, spans, passages) -> F.Column:
    """``struct<kept:binary,n_chars:long>``: the bytes of a text outside ``spans``, and the characters that :func:`kept_text` leaves."""
    kind = pa.struct([("kept", pa.binary()), ("n_chars", pa.int64())])

    @F.arrow_udf("kept binary, n_chars long")
    def kept(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists, coded in batches:
            yield pa.array([{"kept": _cut(texts[i], s), "n_chars": len(_cut(texts[i], s, p).decode("utf-8", "ignore"))}
                            for i, (s, p) in enumerate(zip(lists.to_pylist(), coded.to_pylist(), strict=True))], type=kind)
            give_back()

    return kept(text, spans, passages)


def kept_text(text, spans, passages) -> F.Column:
    """``string``: what stays of a text outside ``spans`` and ``passages`` (null: none), without the characters that a cut runs through."""
    @F.arrow_udf("string")
    def kept(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists, coded in batches:
            yield pa.array([_cut(texts[i], s, p).decode("utf-8", "ignore")
                            for i, (s, p) in enumerate(zip(lists.to_pylist(), coded.to_pylist(), strict=True))], type=pa.string())
            give_back()

    return kept(text, spans, passages)


def row_name(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> F.Column:
    """A hash that names a row by id and text.  Equal rows share it, as they share their result."""
    return F.xxhash64(id_col, text_col)


def repeats(docs: DataFrame, length: int = 400, *, words: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256 (of the bytes that are kept), n_kept (their number).

    With ``words`` also n_passages and n_passage_words: maximal runs of words
    that lie in ``words`` words in a row which occur elsewhere too, and how many words
    those are; short of ``length`` bytes they are found, not removed.  n_chars:
    the characters of the text without them, as :func:`without_repeats` leaves it.

    Null texts are empty.  Texts shorter than ``length`` keep all bytes;
    equal texts of ``length`` bytes or more, repeated rows included, lose all.
    """
    rows = docs.select(F.col(id_col).alias(id_col), row_name(docs, id_col, text_col).alias("row"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    none = F.lit(0).cast("long")
    size = F.aggregate("spans", none, lambda n, s: n + s["b"] - s["a"])
    cut = [F.coalesce(size, none).alias("n_removed"), F.coalesce(F.array_size("spans").cast("long"), none).alias("n_spans")]
    kept = [F.sha2("text", 256).alias("sha256")]
    if words:
        affected, spans, passages = windows_and_passages(rows, length, words)
        found = spans.join(passages.select("row", F.col("spans").alias("passages")), "row", "full")
        inside = F.aggregate("passages", none, lambda n, s: n + F.floor(s["b"] / _WIDTH) - F.ceil(s["a"] / _WIDTH))
        cut += [F.coalesce(F.array_size("passages").cast("long"), none).alias("n_passages"), F.coalesce(inside, none).alias("n_passage_words"),
                F.col("part.n_chars").alias("cut_chars")]
        part = kept_parts(F.col("text"), F.col("spans"), F.col("passages"))
        kept.append(F.length("text").cast("long").alias("chars"))
    else:
        affected, found = repeated_windows(rows, length)
        part = F.struct(kept_bytes(F.col("text"), F.col("spans")).alias("kept"))
    cut.append(F.sha2("part.kept", 256).alias("cut_sha256"))
    names = ["n_removed", "n_spans", *(["n_passages", "n_passage_words", "cut_chars"] if words else []), "cut_sha256"]
    once = (affected.join(found, "row").withColumn("part", part).select("row", *cut)
            .groupBy("row").agg(*(F.first(c).alias(c) for c in names)))
    whole = rows.select(id_col, "row", F.octet_length("text").cast("long").alias("n_bytes"), *kept)
    removed = F.coalesce("n_removed", none)
    out = [F.col(id_col), F.col("n_bytes"), removed.alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"),
           F.coalesce("cut_sha256", "sha256").alias("kept_sha256"), (F.col("n_bytes") - removed).alias("n_kept")]
    if words:
        out += [*(F.coalesce(c, none).alias(c) for c in ("n_passages", "n_passage_words")), F.coalesce("cut_chars", "chars").alias("n_chars")]
    return whole.join(once, "row", "left").select(*out)


def without_repeats(docs: DataFrame, length: int = 400, *, words: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text_col``.

    With ``words``, passages of that many words or more that occur elsewhere
    too go as well, however few bytes they have.  A character that a cut runs
    through goes with it; null texts stay null; rows stay, also those with
    nothing left.
    """
    row, found = PREFIX + "row", PREFIX + "spans"
    rows = docs.withColumn(row, row_name(docs, id_col, text_col))
    texts = rows.select(F.col(row).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    _, spans = repeated_windows(texts, length)

    passages = PREFIX + "passages"
    joined = rows.join(spans.select(F.col("row").alias(row), F.col("spans").alias(found)), row, "left")
    if words:
        joined = joined.join(repeated_passages(texts, words).select(F.col("row").alias(row), F.col("spans").alias(passages)), row, "left")
    else:
        joined = joined.withColumn(passages, F.lit(None).cast("array<struct<a:long,b:long>>"))
    cut = F.col(text_col).isNotNull() & (F.col(found).isNotNull() | F.col(passages).isNotNull())
    text = F.when(cut, kept_text(F.col(text_col), F.col(found), F.col(passages))).otherwise(F.col(text_col))
    return joined.withColumn(text_col, text).select(*docs.columns)
