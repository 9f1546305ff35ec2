"""Cut texts where no tokenizer piece can cross, and keep the ids of chunks seen.

A single space or line break with other characters on both sides always ends
a piece of ``public_tokenizers.PATTERN`` (the space goes with what follows),
so the ids of a text are the ids of its chunks in order.  White space of any
other shape stays inside one chunk.  Most chunks of a corpus occur many
times; a bounded table per Python worker answers those.
"""

from __future__ import annotations

import ctypes
import itertools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_OTHER_SPACE = re.compile("[\t\r\x00\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
_NOT_PLAIN = r"  |\n\n| \n|\n |[\t\r\x00\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")


def plain_space(text: str) -> bool:
    """Only single spaces and single line breaks, none beside another."""
    return not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text or _OTHER_SPACE.search(text))


def cut(text: str) -> list[str]:
    """Chunks of ``text``: joined they are the text, and pieces never cross them."""
    if plain_space(text):
        return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")
    at = [0, *(m.start() for m in _INNER_SPACE.finditer(text)), len(text)]
    return [text[a:b] for a, b in itertools.pairwise(at)]


def cut_all(texts: pa.Array) -> pa.ListArray:
    """``cut`` of each text (null: of an empty one)."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    lists = pc.split_pattern(pc.replace_substring(pc.replace_substring(texts, " ", "\x00 "), "\n", "\x00\n\x00"), "\x00")
    odd = pc.match_substring_regex(texts, _NOT_PLAIN)
    if not pc.any(odd).as_py():
        return lists
    odd = odd.to_numpy(zero_copy_only=False)
    by_hand = pa.array([cut(t) for t in texts.filter(pa.array(odd)).to_pylist()], lists.type)
    order = np.empty(len(texts), dtype=np.int64)
    order[~odd], order[odd] = np.arange((~odd).sum()), np.arange((~odd).sum(), len(texts))
    return pa.concat_arrays([lists.filter(pa.array(~odd)), by_hand]).take(pa.array(order))


class ChunkTable:
    """Values of chunks (packed ids, counts), computed once while they stay here.

    ``compute(chunk, known)`` gives the value of a chunk; ``known`` looks up
    another chunk, such as one of its pieces, without computing it.  Two
    generations of about ``room`` bytes each: when the newer is full it
    becomes the older one, and chunks still in use move back as they occur.
    Chunks of more than ``longest`` characters are not kept.
    """

    #: Bytes that an entry takes besides its texts: two objects' heads and a place in a dictionary.
    HEAD = 200

    def __init__(self, compute, room: int = 52 << 20, longest: int = 4096):
        self.compute, self.room, self.longest = compute, room, longest
        self.now, self.old, self.used = {}, {}, 0

    def known(self, chunk: str):
        got = self.now.get(chunk)
        return self.old.get(chunk) if got is None else got

    def values(self, chunks: list[str]) -> list:
        """The value of each of some distinct chunks."""
        if self.used > self.room:
            self.now, self.old, self.used = {}, self.now, 0
        now, old, known, compute, longest = self.now, self.old, self.known, self.compute, self.longest
        out, used, before = [], 0, len(self.now)
        for c in chunks:
            v = now.get(c)
            if v is None:
                v = old.get(c)
                if v is None:
                    v = compute(c, known)
                if len(c) <= longest:
                    now[c] = v
                    used += len(c) if isinstance(v, int) else len(c) + len(v)
            out.append(v)
        self.used += used + self.HEAD * (len(now) - before)
        return out

    def coded(self, texts: pa.Array, batch_bytes: int = 4 << 20):
        """Runs of texts: the values of their distinct chunks, the chunks as codes into these, and where each text's begin."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        runs = np.cumsum(sizes) // batch_bytes
        try:
            for a, b in itertools.pairwise([0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(texts)] if len(texts) else []):
                lists = cut_all(texts.slice(a, b - a))
                at = lists.offsets.to_numpy().astype(np.int64)
                chunks = lists.flatten().dictionary_encode()
                yield self.values(chunks.dictionary.to_numpy(zero_copy_only=False).tolist()), chunks.indices.to_numpy(), at - at[0]
        finally:
            give_back()

    def sums(self, texts: pa.Array) -> np.ndarray:
        """For each text the sum of its chunks' values."""
        out = [np.zeros(0, dtype=np.int64)]
        for values, codes, at in self.coded(texts):
            through = np.concatenate([[0], np.cumsum(np.array(values, dtype=np.int64)[codes])])
            out.append(through[at[1:]] - through[at[:-1]])
        return np.concatenate(out)

    def ids(self, texts: pa.Array):
        """Runs of texts: their packed 32-bit ids in a row, and where each text's begin (one more than texts)."""
        for values, codes, at in self.coded(texts):
            each = np.array([len(v) >> 2 for v in values], dtype=np.int64)
            first = np.cumsum(each) - each
            n = each[codes]
            through = np.concatenate([[0], np.cumsum(n)])
            where = np.repeat(first[codes] - through[:-1], n)
            where += np.arange(through[-1])
            yield np.frombuffer(b"".join(values), dtype="<u4")[where], through[at]


_TABLES: dict[tuple, ChunkTable] = {}


def worker_table(key: tuple, make) -> ChunkTable:
    """The table of this Python worker for ``key``; one is kept, so its memory is bounded."""
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = make()
    return _TABLES[key]


def give_back() -> None:
    """Return the heap that is free to the system: an idle worker keeps its table, not the room its batches took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not this C library


def forget() -> None:
    """Give back the room of this worker's table when it goes on to other work."""
    if _TABLES:
        _TABLES.clear()
    give_back()
