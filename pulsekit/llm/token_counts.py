"""Token counts by a compiled transducer, without making the tokens.

**Compilation.**  Inside one match of the pattern, the encoding of a prefix is
fixed by its last token and the encoding of what stands before it; and a
token may follow another if the two, merged alone, stay those two.  So all
that the future depends on is the longest suffix that some token could still
grow from, with the last tokens at the positions inside it: finitely many
states.  A transition on a byte carries the number of tokens that the byte
adds to the count (a merge makes it zero or negative).  States and
transitions are compiled when first reached and kept up to a bound.

**Chunks.**  A long text is cut into chunks, rows of their own; each chunk
becomes, in whatever task it lies, a map from the state before it to the
count and the state after it.  A space between two other characters, or a
digit after an ASCII letter, brings every state to the same one, so a map is
held as (text up to the first such place, count between, text from the last
one on).  Maps compose associatively: a round composes each ``fan``
neighbours of a text by a grouped aggregate, so a text of n chunks takes
log(n) rounds and no task sees more than ``fan`` maps.
"""

from __future__ import annotations

import json
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.bpe import merge
from pulsekit.llm.common import PREFIX, pairwise_tree, written
from pulsekit.llm.library_ids import BYTE_LEVEL, byte_alphabet
from pulsekit.llm.textchunks import _INNER_SPACE, ChunkTable, cut, worker_table

START = -1


class CountTransducer:
    """Counts the tokens of one match, a byte at a time."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 400_000):
        self.ranks, self.max_states = ranks, max_states
        self.tokens = {i: b for b, i in ranks.items()}
        self.growing = {b[:k] for b in ranks for k in range(len(b))}
        self.pairs: dict[tuple[int, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        """State 0: nothing read.  A state is (suffix, last token and relative count at each place in it)."""
        self.states = [(b"", (START,), (0,))]
        self.number = {self.states[0]: 0}
        self.steps: dict[int, tuple[int, int]] = {}

    def count(self, piece: bytes) -> int:
        if len(self.states) > self.max_states:
            self._reset()
            self.pairs.clear()
        at = total = 0
        steps = self.steps
        for b in piece:
            step = steps.get(at << 8 | b)
            if step is None:
                step = steps[at << 8 | b] = self._compile(at, b)
            at = step[0]
            total += step[1]
        return total

    def _compile(self, at: int, byte: int) -> tuple[int, int]:
        """The state after ``byte`` and what it adds to the count."""
        suffix, last, counts = self.states[at]
        text = suffix + bytes((byte,))
        for a in range(len(text)):
            token = self.ranks.get(text[a:])
            if token is not None and (last[a] == START or self._stay(last[a], token)):
                break
        else:
            raise ValueError(f"no token for byte {byte}")
        added = counts[a] + 1
        keep = next(k for k in range(len(text) + 1) if text[k:] in self.growing)
        state = (text[keep:], (*last[keep:], token), (*(c - added for c in counts[keep:]), 0))
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
        return self.number[state], added

    def _stay(self, a: int, b: int) -> bool:
        """Merged alone, the two tokens stay two."""
        got = self.pairs.get((a, b))
        if got is None:
            got = self.pairs[a, b] = merge(self.tokens[a] + self.tokens[b], self.ranks) == [a, b]
        return got


class ChunkMap(NamedTuple):
    """What a chunk does to the count: ``head`` ends what came before, ``tail`` is carried on.

    Without a place inside where all states meet (``meets`` false) the whole
    chunk is ``head``.
    """
    head: str
    count: int
    tail: str
    meets: bool


#: Where all states meet: an inner space, or a digit after a letter (other letters than ASCII's may be numbers to the pattern).
_MEETS = re.compile(f"{_INNER_SPACE.pattern}|(?<=[A-Za-z])(?=[0-9])")


def chunk_map(chunk: str, count, meets=_MEETS) -> ChunkMap:
    at = [m.start() for m in meets.finditer(chunk)]
    if not at:
        return ChunkMap(chunk, 0, "", False)
    return ChunkMap(chunk[:at[0]], count(chunk[at[0]:at[-1]]), chunk[at[-1]:], True)


def compose(a: ChunkMap, b: ChunkMap, count) -> ChunkMap:
    if not a.meets:
        return ChunkMap(a.head + b.head, b.count, b.tail, b.meets)
    if not b.meets:
        return ChunkMap(a.head, a.count, a.tail + b.head, True)
    return ChunkMap(a.head, a.count + count(a.tail + b.head) + b.count, b.tail, True)


def text_count(text: str, count, chunk_chars: int) -> int:
    """Tokens of a text: its chunks' maps, composed, applied to the state at the start."""
    if len(text) <= chunk_chars:
        return count(text)
    maps = [chunk_map(text[i:i + chunk_chars], count) for i in range(0, len(text), chunk_chars)]
    whole = pairwise_tree(maps, lambda a, b: compose(a, b, count))
    return count(whole.head) + whole.count + count(whole.tail)


def load_ranks_json(path: str) -> tuple[dict[bytes, int], list[str]]:
    """Ranks (ids) by token bytes, and the special strings, of a byte-level ``tokenizers`` file."""
    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    back = {c: b for b, c in byte_alphabet().items()}
    special = [t["content"] for t in config["added_tokens"]]
    return {bytes(back[c] for c in t): i for t, i in config["model"]["vocab"].items() if t not in special}, special


def _counter(path: str, pattern: str) -> ChunkTable:
    def make():
        import regex

        ranks, special = load_ranks_json(path)
        transducer, find = CountTransducer(ranks), regex.compile(pattern).findall
        parts = regex.compile("|".join(map(regex.escape, special)) or "(?!)")

        def compute(chunk, known):
            """A special string is one token; what stands between is counted piece by piece."""
            some = parts.split(chunk)
            return len(some) - 1 + sum(transducer.count(p.encode()) for s in some for p in find(s))

        return ChunkTable(compute)

    return worker_table(("count", path, pattern), make)


def token_counts(text: Column, path: str, pattern: str = BYTE_LEVEL, chunk_chars: int = 1 << 16) -> Column:
    """``long``: tokens of ``text`` by the byte-level ``tokenizers`` file at ``path`` (null, empty: 0).

    Special strings inside a text count as one token, as the library has it
    by default; no tokens are added, texts are whole.
    """
    @F.arrow_udf("long")
    def counts(texts: pa.Array) -> pa.Array:
        table = _counter(path, pattern)
        long = pc.fill_null(pc.greater(pc.utf8_length(texts), chunk_chars), False).to_numpy(zero_copy_only=False)
        out = np.zeros(len(texts), dtype=np.int64)
        out[~long] = table.sums(texts.filter(pa.array(~long)))
        out[long] = [text_count(t, lambda x: sum(table.values(cut(x))), chunk_chars) for t in texts.filter(pa.array(long)).to_pylist()]
        return pa.array(out)

    return counts(text)


_MAP = "struct<head: string, count: long, tail: string, meets: boolean>"


def _places(path: str) -> re.Pattern:
    """Where states meet, for a file's special strings: none may stand across such a place."""
    _, special = load_ranks_json(path)
    return _INNER_SPACE if any(_MEETS.search(t) for t in special) else _MEETS


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", name: str = "n_tokens", pattern: str = BYTE_LEVEL,
                 chunk_chars: int = 1 << 16, fan: int = 64) -> DataFrame:
    """``docs`` with the tokens of each text (:func:`token_counts`) as ``name``.

    Texts of more than ``chunk_chars`` characters are counted by chunk maps,
    a row a chunk, over all tasks; equal ones once.  What has no place where
    states meet (a single piece, such as one letter very many times) is
    counted in one go.
    """
    kept = [c for c in docs.columns if c != name]
    longest = docs.agg(F.max(F.length(text_col))).first()[0] or 0
    if longest <= chunk_chars:
        return docs.select(*kept, token_counts(F.col(text_col), path, pattern, chunk_chars).alias(name))
    is_long = F.coalesce(F.length(text_col) > chunk_chars, F.lit(False))
    short = docs.filter(~is_long).select(*kept, token_counts(F.col(text_col), path, pattern, chunk_chars).alias(name))
    key, total = PREFIX + "key", PREFIX + "total"
    named = docs.filter(is_long).select(*kept, F.concat(F.md5(text_col), F.length(text_col).cast("string")).alias(key))
    meets = _places(path)

    def counting():
        table = _counter(path, pattern)
        return lambda x: sum(table.values(cut(x)))

    @F.arrow_udf(_MAP)
    def mapped(chunks: pa.Array) -> pa.Array:
        count = counting()
        return pa.array([chunk_map(c, count, meets)._asdict() for c in chunks.to_pylist()], _ARROW_MAP)

    @F.arrow_udf(_MAP)
    def composed(lists: pa.Array) -> pa.Array:
        count = counting()
        return pa.array([pairwise_tree([ChunkMap(**x["m"]) for x in some], lambda a, b: compose(a, b, count))._asdict() for some in lists.to_pylist()],
                        _ARROW_MAP)

    @F.arrow_udf("long")
    def finished(maps: pa.Array) -> pa.Array:
        count = counting()
        return pa.array([count(m["head"]) + m["count"] + count(m["tail"]) for m in maps.to_pylist()], pa.int64())

    texts = named.groupBy(key).agg(F.first(text_col).alias("text"))
    chunks = texts.select(key, F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk_chars}}}"), F.lit(0))).alias("i", "chunk"))
    maps = written(chunks.repartition(key, "i").select(key, "i", mapped("chunk").alias("m")), "chunk-maps")
    n = -(-longest // chunk_chars)
    while n > 1:
        maps = (maps.groupBy(key, F.floor(F.col("i") / fan).cast("int").alias("i2"))
                .agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("some")).select(key, F.col("i2").alias("i"), composed("some").alias("m")))
        n = -(-n // fan)
    counts = maps.select(F.col(key).alias(total), finished("m").alias(name))
    return short.unionByName(named.join(counts, named[key] == counts[total]).select(*kept, name))


_ARROW_MAP = pa.struct([("head", pa.string()), ("count", pa.int64()), ("tail", pa.string()), ("meets", pa.bool_())])
