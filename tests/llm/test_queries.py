"""Every corpus query on tables of awkward cases and on empty ones, against plain Python."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from pulsekit.llm import suffix_dedup
from pulsekit.llm.queries import QUERIES
from pulsekit.llm.simhash import fingerprint_of
from tests.llm import tables


@pytest.fixture(scope="module")
def sf(tmp_path_factory):
    return tables.folder(tmp_path_factory.mktemp("odd"))


@pytest.fixture(scope="module")
def nothing(tmp_path_factory):
    return tables.folder(tmp_path_factory.mktemp("empty"), empty=True)


def docs():
    t = tables.documents()
    return list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True))


def rows(spark, sf, name):
    return [r.asDict() for r in QUERIES[name](spark, sf).collect()]


def bag(values):
    return Counter(map(repr, values))


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_empty_tables(spark, nothing, name):
    query = QUERIES.get(name, corpus_pipeline.run)
    assert query(spark, nothing).collect() == []


def test_sharding(spark, sf):
    got = rows(spark, sf, "op1_sharding")
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs()]
    assert bag((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == bag(want)
    for shard in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert {r["shard"] for r in got} <= set(range(8)) and {r["law"] for r in got} == {"bytes"}


def test_bpe_round_trip(spark, sf):
    import tiktoken

    from pulsekit.llm.bpe import load_ranks
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    want = []
    for i, t in docs():
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = rows(spark, sf, "op4_byte_bpe")
    assert bag((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == bag(want)


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_token_counts(spark, sf):
    ids = library("byte_bpe_50k.json")
    want = [(i, len((t or "").encode()), len(ids(t)), len(ids(t)) > 512) for i, t in docs()]
    assert bag((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows(spark, sf, "op9_token_counts")) == bag(want)


def test_token_store(spark, sf):
    ids = library("byte_bpe_50k.json")
    got = sorted(rows(spark, sf, "op10_token_store"), key=lambda r: r["start"])
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert keys == sorted(keys)
    want = [(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, t in docs() for x in [[*ids(t), 2]]]
    assert bag((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == bag(want)


def check_packing(got, docs, capacity=4096):
    ids = library("word_bpe_49k.json")
    want = []
    for i, t in docs:
        x = np.array([*ids(t), 1], "<u4")
        want += [(i, k, a, len(x[a:a + capacity]), zlib.crc32(x[a:a + capacity].tobytes())) for k, a in enumerate(range(0, len(x), capacity))]
    assert bag((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == bag(want)
    groups: dict[int, list] = {}
    for r in got:
        groups.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for some in groups.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= capacity


def test_packing(spark, sf):
    check_packing(rows(spark, sf, "op7_best_fit_packing"), docs())


def components(keys, near):
    """Smallest reachable index of each, by plain search."""
    out = list(range(len(keys)))
    for i in range(len(keys)):
        if out[i] == i:
            stack = [i]
            while stack:
                x = stack.pop()
                for y in range(len(keys)):
                    if out[y] > i and near(keys[x], keys[y]):
                        out[y] = i
                        stack.append(y)
    return out


def test_simhash(spark, sf):
    some = docs()
    prints = [fingerprint_of(t or "") for _, t in some]
    groups = components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    low: dict[int, int | None] = {}
    for (i, _), g in zip(some, groups, strict=True):
        if i is not None:
            low[g] = min(low.get(g, i), i)
    want = [(i, f"{p:016x}", low.get(g)) for (i, _), p, g in zip(some, prints, groups, strict=True)]
    got = rows(spark, sf, "op3_simhash")
    assert bag((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == bag(want)


def repeated(texts, length):
    """For each text, which bytes go."""
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append(gone)
    return out


def test_suffix_dedup(spark, sf):
    some = [(i, (t or "").encode()) for i, t in docs()]
    want = []
    for (i, t), gone in zip(some, repeated([t for _, t in some], 400), strict=True):
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()
        want.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = rows(spark, sf, "op6_suffix_dedup")
    assert bag(tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in got) == bag(want)
    assert all(r["n_kept"] == r["n_bytes"] - r["n_removed"] for r in got)


def test_suffix_dedup_finds_passages_of_over_50_words(spark, sf):
    """Words as Unicode's spaces cut them, whatever space stands between; runs of words in 51 that occur again."""
    some = [(i, (t or "").split()) for i, t in docs()]
    seen = Counter(tuple(w[a:a + 51]) for _, w in some for a in range(len(w) - 50))
    want = []
    for i, w in some:
        gone = np.zeros(len(w) + 2, dtype=int)
        for a in range(len(w) - 50):
            if seen[tuple(w[a:a + 51])] > 1:
                gone[a + 1:a + 52] = 1
        want.append((i, int((np.diff(gone) == 1).sum()), int(gone.sum())))
    assert sum(n > 0 for _, n, _ in want) > 4
    got = suffix_dedup.repeats(spark.read.parquet(f"{sf}/documents.parquet"), 400, words=51).collect()
    assert bag((r.doc_id, r.n_passages, r.n_passage_words) for r in got) == bag(want)


def test_op6_finds_planted_passages(spark, tmp_path):
    """Passages of 51 to 90 words, most under 400 bytes, in otherwise different documents: the query finds them and leaves clean documents alone."""
    r = random.Random(21)

    def some(n):
        return ["".join(r.choice("abcdefghijklmnopé") for _ in range(r.randrange(1, 7))) for _ in range(n)]

    want, texts = [], []
    for n in (50, 51, 52, 58, 65, 90):
        passage = some(n)
        for space in " \n\xa0":
            a, b = some(80), some(70)
            texts.append(f"{' '.join(a)}\n{space.join(passage)} {' '.join(b)}")
            want.append((n, f"{' '.join(a)}\n {' '.join(b)}") if n > 50 else (0, texts[-1]))
    texts += ["clean é " + " ".join(some(200)), None, "", " \n", "one"]
    want += [(0, t or "") for t in texts[-5:]]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x for x in QUERIES["op6_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    short = 0
    for i, (n, left) in enumerate(want):
        assert (got[i].n_passages, got[i].n_passage_words, got[i].n_chars) == (int(n > 0), n, len(left)), i
        short += n > 0 and got[i].n_removed == 0
    assert short >= 10


@pytest.mark.parametrize("crowded", [50_000, 1])
def test_short_passages(spark, crowded):
    """Runs of words in six that occur again, in short texts with many repeats: one sweep gives both kinds as brute force does."""
    r = random.Random(17)
    parts = [" ".join(r.choice("abcde") for _ in range(n)) for n in (6, 7, 9, 14)]
    some = [r.choice([" ", "\n", "  "]).join(r.choice([*parts, "a a a a a a a a a", *"abcdefghij"]) for _ in range(r.randrange(12))) for _ in range(70)]
    frame = spark.createDataFrame(list(enumerate(some)), "row long, text string").repartition(5)
    _, spans, passages = suffix_dedup.windows_and_passages(frame, 20, 6, crowded=crowded)
    found = [{x.row: [(s.a, s.b) for s in x.spans] for x in f.collect()} for f in (spans, passages)]
    for kind, items, length, unit in ((0, [t.encode() for t in some], 20, 1), (1, [tuple(t.split()) for t in some], 6, 8)):
        for i, gone in enumerate(repeated(items, length)):
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]]))) * unit
            assert found[kind].get(i, []) == list(zip(edges[::2], edges[1::2], strict=True)), (kind, i)
    assert sum(map(len, found[1].values())) > 30


def valid(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def vectors():
    t = tables.vectors()
    return list(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist(), strict=True))


def test_embedding_dedup(spark, sf):
    some = vectors()
    ok = [i for i, (k, v) in enumerate(some) if k is not None and valid(v)]

    def near(a, b):
        x, y = (np.array(some[i][1]) for i in (a, b))
        return len(x) == len(y) and bool(x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95)

    groups = components(ok, near)
    low = {g: min(some[ok[j]][0] for j in range(len(ok)) if groups[j] == g) for g in groups}
    want = [(some[i][0], sum(j != i and near(i, j) for j in ok), low[g], some[i][0] == low[g]) for i, g in zip(ok, groups, strict=True)]
    want += [(k, 0, k, None if k is None else True) for i, (k, _) in enumerate(some) if i not in ok]
    got = rows(spark, sf, "op2_embedding_dedup")
    assert bag((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == bag(want)


def test_nearest(spark, sf):
    some = {k: np.array(v) for k, v in vectors() if k is not None and valid(v)}
    got: dict[int, list] = {}
    for r in sorted(rows(spark, sf, "op5_nearest"), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r)
    assert set(got) == {k for k in some if k % 20 == 0}
    hits = total = 0
    for q, found in got.items():
        scores = sorted(((-float(some[q] @ v), k) for k, v in some.items() if k != q and len(v) == len(some[q])))
        best = [k for _, k in scores[:20]]
        assert len(found) == len(best) and [r["rank"] for r in found] == list(range(1, len(best) + 1))
        for r in found:
            assert abs(r["score"] - float(some[q] @ some[r["vec_id"]])) < 1e-9
        order = [(-r["score"], r["vec_id"]) for r in found]
        assert order == sorted(order) and len({r["vec_id"] for r in found}) == len(found)
        hits += len(set(best) & {r["vec_id"] for r in found})
        total += len(best)
    assert hits / total >= 0.9


def test_toxicity(spark, sf):
    got = rows(spark, sf, "op8_toxicity")
    assert len(got) == len(docs())
    for r in got:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert r["held_out"] == held and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shared(texts, items, span=10):
    """For each text its words, how many lie in a window of an item, and which items those are."""
    windows: dict[tuple, set] = {}
    for i, t in items:
        w = words(t)
        n = min(span, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[a:a + n]), set()).add(i)
    out = []
    for t in texts:
        w, hit, ids = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in windows:
                    hit |= set(range(a, a + n))
                    ids |= windows[tuple(w[a:a + n])]
        out.append((len(w), len(hit), sorted(str(i) for i in ids - {None})))
    return out


def test_decontamination(spark, sf):
    b = tables.benchmark()
    items = list(zip(b["item_id"].to_pylist(), b["text"].to_pylist(), strict=True))
    found = shared([t for _, t in docs()], items)
    assert sum(h > 0 for _, h, _ in found) > 5
    want = [(i, n, h, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), h > 0) for (i, _), (n, h, ids) in zip(docs(), found, strict=True)]
    got = rows(spark, sf, "op11_decontamination")
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert bag(tuple(r[c] for c in names) for r in got) == bag(want)


def test_whitening(spark, sf):
    """Against a dense eigendecomposition; the 16-dimensional vectors are the commonest."""
    some = [(k, v) for k, v in vectors() if v is not None and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v)]
    x = np.floor(256 * np.array([np.array(v, dtype=np.float32).astype(float) for _, v in some]))
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    e, q = np.linalg.eigh((fit - total / n).T @ (fit - total / n) / n)
    e, q = e[::-1], q[:, ::-1]
    got: dict[tuple, list] = {}
    for r in rows(spark, sf, "op12_whitening"):
        assert r["n"] == n and abs(r["explained"] / (e[r["component"] - 1] / e.sum()) - 1) < 1e-9 and r["identity_error"] < 1e-9
        got.setdefault((repr(r["vec_id"]), r["deviation"]), []).append((r["component"], r["whitened"]))
    want = (x - total / n) @ q[:, :4] / np.sqrt(e[:4])
    deviations = ((n * x.astype(int) - total.astype(int)) ** 2).sum(axis=1)
    assert bag(k for k, v in got.items() for _ in v) == bag((repr(k), int(d)) for (k, _), d in zip(some, deviations, strict=True) for _ in range(4))
    for c in range(4):
        mine = np.array([dict(got[repr(k), int(d)])[c + 1] for (k, _), d in zip(some, deviations, strict=True)])
        assert min(np.abs(mine - want[:, c]).max(), np.abs(mine + want[:, c]).max()) < 1e-9


SPACE = " \t\n\x0b\x0c\r"
AFTER = {"s": ({0}, 1), "u": ({0, 1, 3}, 2), "a": ({2}, 3)}


def cheapest(some):
    """Faults and the least (cost, audit, lines) of rows (turn, role, text), one row at a time."""
    some = sorted(some, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = [t for t, _, _ in some if t is not None]
    seen, faults = set(), []
    for _, role, text in some:
        bare = text.strip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(some))
    best = {0: (0, "", ())}

    def put(into, state, way):
        if state not in into or way[:2] < into[state][:2]:
            into[state] = way

    def with_inserts(ways):
        ways = dict(ways)
        for _ in range(4):
            for state, (cost, audit, lines) in list(ways.items()):
                for name, line in (("u", "user:"), ("a", "assistant:")):
                    if state in AFTER[name][0]:
                        put(ways, AFTER[name][1], (cost + 3, audit + "I", (*lines, line)))
        return ways

    for (_, role, text), fault in zip(some, faults, strict=True):
        now = {}
        for state, (cost, audit, lines) in with_inserts(best).items():
            put(now, state, (cost + 4, audit + "D", lines))
            if fault in ("", "truncated"):
                cost += 3 * (fault == "truncated")
                if state in AFTER.get(role[:1], ((), 0))[0]:
                    put(now, AFTER[role[0]][1], (cost, audit + "K", (*lines, f"{role}:{text}")))
                for name, full in (("u", "user"), ("a", "assistant")):
                    if state in AFTER[name][0]:
                        put(now, AFTER[name][1], (cost + 3, audit + "R", (*lines, f"{full}:{text}")))
        best = now
    ways = with_inserts(best)
    cost, audit, lines = min(ways[s] for s in (0, 3) if s in ways)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps if gaps < 2**63 else None, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged():
    t = tables.conversations()
    out: dict = {}
    for conv, turn, role, text in zip(*(t[c].to_pylist() for c in ("conv_id", "turn", "role", "text")), strict=True):
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out.setdefault(conv, []).extend([(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    return out


REPAIR = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_conversation_repair(spark, sf):
    got = rows(spark, sf, "op13_conversation_repair")
    assert bag(tuple(r[c] for c in REPAIR) for r in got) == bag((conv, *cheapest(some)) for conv, some in damaged().items())


@pytest.mark.parametrize("block_rows", [1, 3, 50])
def test_conversations_over_many_blocks(spark, sf, block_rows):
    """Small blocks, so that most conversations are walks over several."""
    from pyspark.sql import functions as F

    from pulsekit.llm import conversation_repair
    from pulsekit.llm.queries import damaged as query_damaged
    got = conversation_repair.repaired(query_damaged(spark.read.parquet(f"{sf}/conversations.parquet")), copies=F.col("copies"),
                                       block_rows=block_rows, least=2, broadcast_bytes=0).collect()
    assert bag(tuple(r[c] for c in REPAIR) for r in got) == bag((conv, *cheapest(some)) for conv, some in damaged().items())


def test_pipeline(spark, sf):
    """Stage by stage against plain versions, each on what the stage before it kept."""
    start = spark.read.parquet(f"{sf}/documents.parquet")
    names = start.columns
    clean = corpus_pipeline.clean(spark, start, sf)
    assert clean.columns == names and 0 < clean.count() <= start.count()
    one = corpus_pipeline.distinct(spark, clean, sf).collect()
    before = [(r.doc_id, r.text) for r in clean.collect()]
    prints = [fingerprint_of(t or "") for _, t in before]
    groups = components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    assert len(one) == len(set(groups))
    lows = {g: min((i is None, i or 0) for (i, _), h in zip(before, groups, strict=True) if h == g) for g in groups}
    assert bag(r.doc_id for r in one) == bag(None if unnamed else i for unnamed, i in lows.values())
    kept = spark.createDataFrame(one, clean.schema)
    cut = corpus_pipeline.unrepeated(spark, kept, sf)
    assert cut.columns == names
    some = [(r.doc_id, r.text) for r in one]
    gone = repeated([(t or "").encode() for _, t in some], 400)
    want = [(i, None if t is None else np.frombuffer(t.encode(), dtype=np.uint8)[~g].tobytes().decode("utf-8", "ignore"))
            for (i, t), g in zip(some, gone, strict=True)]
    last = cut.collect()
    assert bag((r.doc_id, r.text) for r in last) == bag(want)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in last)
    check_packing([r.asDict() for r in corpus_pipeline.run(spark, sf).collect()], want)


def test_pipeline_cuts_passages_of_over_50_words(spark):
    """Passages of 51 to 65 words, all under 400 bytes, go from otherwise different documents; 50 words stay."""
    r = random.Random(12)

    def some(n):
        return ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(1, 7))) for _ in range(n)]

    want, rows = [], []
    for k, n in enumerate((50, 51, 52, 58, 65)):
        passage = some(n)
        assert len(" ".join(passage)) < 400
        for copy, space in enumerate([" ", "\n", "\xa0"]):
            a, b = " ".join([*some(70), f"é{k}.{copy}"]), " ".join([f"{copy}.{k}é", *some(40 * copy)])
            rows.append((len(rows), f"{a}\n{space.join(passage)} {b}"))
            want.append(rows[-1][1] if n == 50 else f"{a}\n {b}")
    rows += [(90, None), (91, ""), (92, " \n"), (93, "one")]
    want += [None, "", " \n", "one"]
    got = corpus_pipeline.unrepeated(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "")
    assert [x.text for x in sorted(got.collect(), key=lambda x: x.doc_id)] == want
