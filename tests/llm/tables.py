"""Small tables that hold the awkward cases, written as the queries read them."""

import os
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

WORDS = "the of and to in river stone window garden letter seven music paper bright north cloud under table green".split()


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ",", ".", "ly", "ing", "é"]) for _ in range(words))


def texts() -> list:
    shared = prose(1, 120)
    return [
        None, "", " ", "  \n\n\t ", "a", "one two three", "ONE Two\tthree", prose(2, 300), prose(2, 300), prose(2, 300) + " tail",
        prose(3, 40) + "\n" + shared + "\n" + prose(4, 60), prose(5, 80) + " " + shared, shared, "x" * 3000, "ab " * 700,
        prose(6, 20_000), "don't you're I'll <|endoftext|> 12³ ½ \x1c \xa0 漢字 😀 é", prose(7, 500), prose(8, 9) + " stupid idiot trash",
        "line\r\nline\r\n\r\nline " * 40, "\x00null\x00", prose(9, 450)]


def documents(extra: bool = True) -> pa.Table:
    some = texts()
    ids = [*range(len(some))]
    ids += [7, 7, None, None, 500, 501]                      # repeated rows, an id twice, null ids
    some += [some[7], "another text under an old id", None, prose(2, 300), prose(2, 300), prose(10, 200)]
    n = len(some)
    cols = {"doc_id": pa.array(ids, pa.int64()), "text": pa.array(some, pa.string()),
            "lang": pa.array([None if i % 5 == 0 else "en" for i in range(n)], pa.string()),
            "source": pa.array([None if i % 7 == 0 else f"src{i % 2}" for i in range(n)], pa.string()),
            "n_chars": pa.array([None if t is None else len(t) for t in some], pa.int64())}
    if extra:  # names that the operators use themselves
        for name in ("shard", "slot", "row", "spans", "ids", "fp", "key", "score", "piece", "length", "component_id", "n", "size",
                     "sequence_id", "offset", "start", "vec", "low", "n_kept", "text_crc32", "words", "n_words", "hashes", "grams", "at", "w"):
            cols[name] = pa.array([None if i % 3 == 0 else i for i in range(n)], pa.int64())
    return pa.table(cols)


def labels() -> pa.Table:
    return pa.table({"doc_id": pa.array([0, 1, 4, 5, 7, 8, 9, 10, 11, 12, 17, 18, 18, None, 21], pa.int64()),
                     "quality": pa.array([1] * 15, pa.int32()),
                     "toxic": pa.array([0, 0, 0, 0, 0, None, 0, 0, 0, 0, 0, 1, 1, 1, 0], pa.int32()), "text": pa.array(["?"] * 15)})


def vectors() -> pa.Table:
    r = np.random.default_rng(4)
    base = r.standard_normal((60, 16)).astype(np.float32)
    rows = [list(map(float, v)) for v in base]
    rows += [rows[3], rows[3], [2 * x for x in rows[5]], [x + 0.01 for x in rows[6]], [-x for x in rows[7]]]
    rows += [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [1.0, 2.0001]]
    ids = [*range(len(rows))]
    rows += [rows[0], rows[20]]
    ids += [0, None]
    return pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(rows, pa.list_(pa.float32())),
                     "label": pa.array([None if i % 4 == 0 else i for i in range(len(ids))], pa.int32()), "cid": pa.array(ids, pa.int64())})


def benchmark() -> pa.Table:
    some = [" ".join(texts()[7].split()[40:75]), prose(1, 120)[30:200], "Ab, aB", "", None, "!!", prose(50, 30), " ".join(prose(9, 450).split()[:10]),
            " ".join(texts()[7].split()[60:72]), "漢字 😀 é", prose(11, 9), prose(1, 120)]
    ids = [*range(100, 100 + len(some) - 2), 100, None]      # an id twice, a null id
    return pa.table({"item_id": pa.array(ids, pa.int64()), "text": pa.array(some, pa.string()), "words": pa.array(ids, pa.int64()),
                     "window": pa.array(["?"] * len(ids))})


def conversations() -> pa.Table:
    r = random.Random(3)
    rows = []
    for c in range(60):
        for t in range(r.randrange(0, 9)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((c, r.choice([t, t, t, t, 2 * t, None, 0]), role, r.choice(["Yes.", "No", " ", None, prose(t, 9) + "!", "é?\n", "So. \t", "", "why"])))
    rows += rows[:25] + [(None, 1, "user", "Hm."), (None, None, None, None), (None, 2, "assistant", "Ok.")]
    rows += [(900, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(300)]           # long
    rows += [(901, None, "user", "again.")] * 40 + [(902, 5, "system", "x.")] + [(903, -2**63, "user", "a."), (903, 2**63 - 1, "assistant", "b.")]
    r.shuffle(rows)
    c, t, who, text = zip(*rows, strict=True)
    return pa.table({"conv_id": pa.array(c, pa.int64()), "turn": pa.array(t, pa.int64()), "role": pa.array(who, pa.string()),
                     "text": pa.array(text, pa.string()), "n": pa.array([None] * len(c), pa.int64()), "conv": pa.array(c, pa.int64()),
                     "seq": pa.array(["x"] * len(c))})


def folder(path, docs=None, empty: bool = False) -> str:
    tables = {"documents": docs if docs is not None else documents(), "labels": labels(), "embeddings": vectors(), "benchmark": benchmark(),
              "conversations": conversations()}
    for name, t in tables.items():
        pq.write_table(t.slice(0, 0) if empty else t, os.path.join(path, f"{name}.parquet"))
    return str(path)
