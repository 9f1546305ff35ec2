"""Ids as the ``tokenizers`` library gives them, through the chunk table.

The merges are the library's (``model.tokenize``), on each piece that is not
in the table.  Before them the pattern and the normaliser named in the
tokenizer's file cut and fold the chunk here, where that is sure to give what
the library gives; any other chunk goes through ``Tokenizer.encode``.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa

from pulsekit.llm.textchunks import ChunkTable, worker_table

#: What ``ByteLevel`` with ``use_regex`` cuts by (fixed value of the format).
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _front(config: dict) -> tuple[str | None, bool]:
    """The pattern whose matches are the pieces (None: not known here), and if letters are folded."""
    pre, norm = config.get("pre_tokenizer") or {}, config.get("normalizer")
    if norm is None and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
        return BYTE_LEVEL, False
    steps = [n["type"] for n in norm["normalizers"]] if norm and norm["type"] == "Sequence" else []
    cuts = pre.get("pretokenizers", [])
    if steps == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cuts] == ["Split", "ByteLevel"] \
            and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] and not cuts[1]["use_regex"]:
        return cuts[0]["pattern"]["Regex"], True
    return None, False


def library_table(path: str) -> ChunkTable:
    """Chunks to packed little-endian unsigned 32-bit ids, without added special tokens.

    Special strings inside a text hold no space, so they lie in one chunk and
    the library treats them there as it does in the whole text.
    """
    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        pattern, folds = _front(config)
        by_library = [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
        if folds:  # letters whose folding or composition may depend on their neighbours
            by_library.append("[\u0130-\U0010ffff]")
        slow = re.compile("|".join(by_library or ["(?!)"]) if pattern else "").search
        find = regex.compile(pattern or "").findall
        model, letters = tokenizer.model, byte_alphabet()

        def piece_ids(piece):
            return array("I", [t.id for t in model.tokenize(piece.encode().decode("latin-1").translate(letters))]).tobytes()

        def compute(chunk, known):
            if slow(chunk):
                return array("I", tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
            if folds:
                chunk = chunk.lower()
            elif chunk[1:].isalpha() and chunk[0] == " ":  # one piece, most chunks
                return piece_ids(chunk)
            out = []
            for piece in find(chunk):
                got = known(piece)
                out.append(piece_ids(piece) if got is None else got)
            return b"".join(out)

        return ChunkTable(compute)

    return worker_table(("library", path), make)


def library_ids(path: str, texts: pa.Array, end_id: int | None = None):
    """Runs of texts (null: empty): their ids in a row, ``end_id`` after each, and where each text's begin (one more than texts)."""
    for ids, at in library_table(path).ids(texts):
        yield (ids, at) if end_id is None else (np.insert(ids, at[1:], end_id), at + np.arange(len(at)))
