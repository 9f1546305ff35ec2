"""The algorithms inside the corpus operators, on their own."""

import bisect
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulsekit.llm import ann, bpe, packing, sharding, suffix_dedup, textchunks, toxicity
from pulsekit.llm.components import connected_components
from pulsekit.llm.library_ids import library_ids
from pulsekit.llm.simhash import links, segments
from pulsekit.llm.suffix_array import suffix_array
from pulsekit.llm.token_counts import BYTE_LEVEL, _counter, text_count
from pulsekit.llm.token_store import from_planes, to_planes

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXT = st.text(alphabet=st.sampled_from(" \n\t\r\x0b\x1c\xa0ab'sretZ1²Ⅷé漢😀<|>.,-_́ "), max_size=60)


def test_chunks_never_cut_a_piece():
    import regex

    find = regex.compile(public_tokenizers.PATTERN).findall

    @settings(max_examples=400, deadline=None)
    @given(TEXT)
    def check(text):
        chunks = textchunks.cut(text)
        assert "".join(chunks) == text
        assert [p for c in chunks for p in find(c)] == find(text)
        assert textchunks.cut_all(pa.array([text, None, text])).to_pylist() == [chunks, [""], chunks]

    check()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_library_ids(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.one_of(TEXT, st.sampled_from(["<|endoftext|>a", "İstanbul ΑΣ ſ"])), max_size=4))
    def check(texts):
        got = [ids[a:b].tolist() for ids, at in library_ids(public_tokenizers.path(name), pa.array(texts, pa.string()))
               for a, b in zip(at[:-1], at[1:], strict=True)]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]

    check()


def test_merges_and_counts():
    ranks = bpe.load_ranks(RANKS)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    table = _counter(public_tokenizers.path("byte_bpe_50k.json"), BYTE_LEVEL)
    count = lambda t: sum(table.values(textchunks.cut(t)))

    @settings(max_examples=400, deadline=None)
    @given(st.one_of(TEXT, st.text(alphabet="abcde", min_size=20, max_size=200)), st.integers(1, 9))
    def check(text, size):
        ids = enc.encode_ordinary(text)
        got = [i for p in __import__("regex").findall(public_tokenizers.PATTERN, text) for i in bpe.merge(p.encode(), ranks)]
        assert got == ids
        if "<|endoftext|>" not in text:
            assert text_count(text, count, size) == len(ids)

    check()
    long = "abcab" * 4000
    assert bpe.merge(long.encode(), ranks) == enc.encode_ordinary(long)


@given(st.lists(st.integers(0, 3), max_size=40))
@settings(max_examples=500, deadline=None)
def test_suffix_array(symbols):
    assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


@pytest.mark.parametrize("mode", ["byte", "bit"])
def test_planes(mode):
    ids = np.random.default_rng(1).integers(0, 1 << 32, 1001, dtype=np.uint64).astype("<u4")
    for n in (0, 1, 8, 1001):
        assert (from_planes(to_planes(ids[:n], mode), n, mode) == ids[:n]).all()


@given(st.lists(st.integers(1, 64), max_size=200))
@settings(max_examples=200, deadline=None)
def test_best_fit_runs(lengths):
    """Each document is placed once, sequences hold, and there are about as few as sequential best-fit makes."""
    seen, used = Counter(), Counter()
    for size, rank, count, sequence, offset in packing.best_fit_runs(Counter(lengths), 64):
        for i in range(count):
            seen[size, rank + i] += 1
            assert used[sequence + i] == offset
            used[sequence + i] += size
    assert set(seen) == {(s, i) for s, n in Counter(lengths).items() for i in range(n)} and set(seen.values()) <= {1}
    assert all(n <= 64 for n in used.values())
    gaps, bins = [], 0
    for x in sorted(lengths, reverse=True):
        k = bisect.bisect_left(gaps, x)
        bins += k == len(gaps)
        bisect.insort(gaps, (gaps.pop(k) if k < len(gaps) else 64) - x)
    assert len(used) <= bins * 1.1 + 1


@given(st.lists(st.integers(0, 50), min_size=1, max_size=6), st.integers(1, 6))
@settings(max_examples=200, deadline=None)
def test_transfers_move_the_fewest_bytes(sizes, n):
    capacities = sharding.even_capacities(sum(sizes), n)
    cuts = sharding.transfers(dict(enumerate(sizes)), capacities)
    into = [sum(b - a for _, j, a, b in cuts if j == k) for k in range(n)]
    assert into == capacities
    moved = sum(b - a for i, j, a, b in cuts if i != j)
    assert moved == sum(sizes) - sum(min(s, c) for s, c in zip(sizes, capacities, strict=False))


def test_flow_with_costs():
    """A cheaper plan needs a detour through another shard's room."""
    cost = [[1, 4], [1, 9]]
    flow = sharding.min_cost_flow([5, 5], [5, 5], lambda i, j: cost[i][j])
    assert flow == {(0, 1): 5, (1, 0): 5}


def test_segments_leave_one_near():
    for d in range(8):
        cuts = segments(d)
        assert sum(n for _, n in cuts) == 64 and d // len(cuts) <= 1


def test_links_in_tiles(spark):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(30)]
    prints = {b ^ sum(1 << i for i in r.sample(range(64), k)) for b in base for k in (0, 1, 2, 4, 5, 7)} | {base[0] ^ i for i in range(200)}
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r.node: r.component for r in connected_components(links(frame, 4, tile=16)).collect()}
    order = sorted(prints)
    for i, a in enumerate(order):
        for j, b in enumerate(order[:i]):
            if (a ^ b).bit_count() <= 4:
                assert found[signed[i]] == found[signed[j]]
    for (u, v) in [(r.u, r.v) for r in links(frame, 4, tile=16).collect()]:
        assert ((u ^ v) & (1 << 64) - 1).bit_count() <= 4


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 400)] + [(0, i) for i in range(1, 90)] + [(r.randrange(1000, 1400), r.randrange(1000, 1400)) for _ in range(300)] + [(7, 7), (5000, 4000), (4000, 5000)]
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        up[max(a, b)] = min(a, b)
    assert got == {x: find(x) for u, v in edges if u != v for x in (u, v)}


def test_anchors_depend_on_the_window_alone():
    r = random.Random(5)
    for length in (8, 20, 60):
        windows = suffix_dedup.Windows(length)
        base = bytes(r.randrange(97, 105) for _ in range(3 * length))
        seen = {}
        for _ in range(6):
            some = [bytes(r.randrange(97, 105) for _ in range(r.randrange(2 * length))) + base[r.randrange(length):], b"a" * 2 * length, b"", b"b" * length]
            data, at = np.frombuffer(b"".join(some), dtype=np.uint8), np.cumsum([0, *map(len, some)])
            found = 0
            for t, lo, hi, anchor, key in zip(*windows.anchors(data, at), strict=True):
                for p in range(lo, hi + 1):
                    found += 1
                    assert at[t] <= p <= anchor < p + windows.half and p + length <= at[t + 1]
                    assert seen.setdefault(bytes(data[p:p + length]), (anchor - p, key)) == (anchor - p, key)
            assert found == sum(max(0, len(t) - length + 1) for t in some)


@pytest.mark.parametrize("crowded,piece", [(50_000, 1 << 20), (1, 1 << 20), (50_000, 13), (1, 50)])
def test_repeats_of_short_strings(spark, crowded, piece):
    """Sorted contexts and the digests of crowded anchors both give what brute force gives, and texts in pieces what whole ones give."""
    from tests.llm.test_queries import repeated
    r = random.Random(8)
    parts = ["".join(r.choice("abcd") for _ in range(n)) for n in (30, 40, 60)]
    some = ["".join(r.choice([*parts, "xyz", "aaaaaaaaaaaaaa", "".join(r.choice("abcd") for _ in range(9))]) for _ in range(r.randrange(8))) for _ in range(60)]
    frame = spark.createDataFrame(list(enumerate(some)), "row long, text string").repartition(5)
    _, spans = suffix_dedup.repeated_windows(frame, length=20, crowded=crowded, piece=piece)
    got = {x.row: [(s.a, s.b) for s in x.spans] for x in spans.collect()}
    for i, gone in enumerate(repeated([t.encode() for t in some], 20)):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        assert got.get(i, []) == list(zip(edges[::2], edges[1::2], strict=True))


def test_parts_keep_an_anchor_whole():
    """Pairs of near copies of one frequent passage: each window repeats in one other context, however small the parts."""
    windows = suffix_dedup.Windows(20)
    passage = b"the frequent passage in the middle of all"
    r = random.Random(3)
    some = []
    for _ in range(25):
        left, right = (bytes(r.randrange(97, 123) for _ in range(30)) for _ in range(2))
        some += [left + passage + right, left + passage + right[:15] + bytes(r.randrange(97, 123) for _ in range(15))]
    at = np.cumsum([0, *map(len, some)])
    text, lo, hi, anchor, _ = windows.anchors(np.frombuffer(b"".join(some), dtype=np.uint8), at)
    places = [[] for _ in some]
    for t, first, last, a in zip(text.tolist(), lo.tolist(), hi.tolist(), anchor.tolist(), strict=True):
        places[t].append(a - int(at[t]) + suffix_dedup._PLACE * ((a - first) + suffix_dedup._SPAN * (a - last)))
    docs = pa.RecordBatch.from_pydict({"row": list(range(len(some))), "text": some, "places": places})
    contexts = pa.Table.from_batches(suffix_dedup._contexts(windows)([docs])).sort_by("key").combine_chunks()

    def found(part):
        return {tuple(x.values()) for b in suffix_dedup._repeats(windows, part)(contexts.to_batches()) for x in b.to_pylist()}

    assert len(found(1000)) > 50
    for part in (1, 7, 30):
        assert found(part) == found(1000)
    group = np.array([1, 1, 1, 2, 3, 3, 4, 4, 4, 4, 4, 5])
    parts = suffix_dedup._whole_parts(np.arange(12), group, 4)
    assert [p.tolist() for p in parts] == [[0, 1, 2, 3], [4, 5], [6, 7, 8, 9, 10], [11]]
    assert suffix_dedup._whole_parts(np.arange(0), group[:0], 4) == []


def test_repeats_of_long_strings(spark):
    """Anchors further than 2,048 bytes into their windows; a length that places cannot hold is refused."""
    r = random.Random(9)
    shared, *own = ("".join(r.choice("abcdefgh") for _ in range(n)) for n in (11_000, 900, 700, 800))
    frame = spark.createDataFrame([(1, own[0] + shared + own[1]), (2, shared + own[2])], "row long, text string")
    _, spans = suffix_dedup.repeated_windows(frame, length=9000)
    assert {x.row: [(s.a, s.b) for s in x.spans] for x in spans.collect()} == {1: [(900, 11_900)], 2: [(0, 11_000)]}
    with pytest.raises(ValueError):
        suffix_dedup.Windows(140_000)


def test_probes_in_order():
    template = ann.probe_template(4, 81)
    assert template.shape == (81, 8) and not template[0].any()
    assert not (template[:, :4] & template[:, :3:-1]).any()          # never both sides of one value
    assert len({tuple(t) for t in template.tolist()}) == 81
    tables = ann.Tables(6, 1, 4, 2.0)
    q = np.random.default_rng(2).standard_normal((3, 7))
    assert (tables.probes(q, 0, 5)[:, 0] == tables.bucket(q, 0)).all()


def test_swaps_take_the_weight_off_a_name(spark):
    """Toxic rows often name a group; without the penalty a neutral mention is raised, with it it is not."""
    r = random.Random(2)
    plain = "we went home and had dinner then read a book near the lake all day".split()

    def row(i):
        toxic = i % 2
        words = r.sample(plain, 6) + (["vile"] if toxic and r.random() < 0.6 else []) + (["muslims"] if r.random() < (0.9 if toxic else 0.05) else [])
        r.shuffle(words)
        return i, " ".join(words), toxic

    frame = spark.createDataFrame([row(i) for i in range(600)], "doc_id long, text string, toxic int")
    neutral = spark.createDataFrame([(f"muslims went home and had {w}",) for w in plain], "text string")
    bad = spark.createDataFrame([("vile people near the lake",)], "text string")

    def mean(model, f):
        return f.select(toxicity.score(f["text"], model).alias("s")).agg({"s": "avg"}).first()[0]

    without = toxicity.fit(frame, frame, swap=0.0)
    swapped = toxicity.fit(frame, frame, swap=5.0)
    assert toxicity.swapped("Muslims and men") == "christians and women"
    assert mean(without, neutral) > 0.6 > mean(swapped, neutral)
    assert mean(swapped, bad) > 0.5


def test_windows_across_segments(spark):
    """Short segments, short items, frequent fingerprints and joins without broadcast give what a scan of all windows gives."""
    from pulsekit.llm.decontamination import contaminated
    from tests.llm.test_queries import shared
    r = random.Random(5)
    texts = [" ".join(r.choice("ab c d e".split()) for _ in range(r.randrange(0, 60))) for _ in range(80)] + [None, "", "?!"]
    items = [(i, " ".join(r.choice("ab c d e".split()) for _ in range(n))) for i, n in enumerate([1, 3, 6, 6, 7, 9, 9, 12, 14, 20])]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (0, 1000):
        for some in (items, items[5:]):
            got = contaminated(docs, bench.filter(f"item_id >= {some[0][0]}"), span=6, gram=3, step=7, broadcast_rows=limit).collect()
            want = [(i, texts[i], *x) for i, x in enumerate(shared(texts, some, 6))]
            assert sorted(((r.doc_id, r.text, r.n_words, r.n_hit, list(r["items"])) for r in got), key=repr) == sorted(want, key=repr)


def test_filtered_iteration_finds_close_values(spark):
    """Ninety dimensions, leading values close to the rest and two of them equal; few passes, certified."""
    import numpy as np

    from pulsekit.llm.whitening import leading_components
    rng = np.random.default_rng(2)
    x = rng.integers(-900, 900, (3000, 90))
    x[:, :3] = np.floor(x[:, :3] * [1.25, 1.2, 1.16])
    x = np.vstack([x, -x])                                     # mean zero
    fit = spark.createDataFrame([(r,) for r in x.tolist()], "x array<long>").repartition(5)
    got = leading_components(fit, len(x), x.sum(axis=0).tolist(), 4)
    e, q = np.linalg.eigh(x.T @ x / len(x))
    assert np.allclose(got.values, e[::-1][:4], rtol=1e-11) and got.angles.max() < 1e-9 and got.passes < 150
    assert np.abs(np.abs((got.vectors * q[:, ::-1][:, :4]).sum(axis=0)) - 1).max() < 1e-12
    assert abs(got.trace / e.sum() - 1) < 1e-12


def test_whitening_of_few_and_large_vectors(spark):
    from pulsekit.llm.whitening import whiten
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)], "vec_id long, embedding array<double>")
    rows, found, _ = whiten(one)
    assert [(r.vec_id, r.whitened, r.deviation) for r in rows.orderBy("vec_id").collect()] == [(1, [], 0), (2, [], 0)] and found.n == 1
    wide = spark.createDataFrame([(1, [1e15, 0.0]), (2, [0.0, 0.0]), (3, [1e30, 0.0]), (4, [-0.001, 0.0])], "vec_id long, embedding array<double>")
    rows, found, error = whiten(wide)
    got = {r.vec_id: r for r in rows.collect()}
    assert set(got) == {1, 2, 4} and got[1].deviation is None and len(got[1].whitened) == 1 and found.sums[0] == 256 * 10**15 - 1 and error < 1e-9


def test_grammar_solves_what_single_rows_solve():
    """Any grammar gives the cheapest edits, and of equal ones the least; checked against all edits of short sequences."""
    import itertools

    from pulsekit.llm.repair_grammar import START, STATES, Grammar, ending, text_of
    from tests.llm.test_queries import cheapest
    grammar = Grammar()
    assert grammar.add([(0, 1), (1, 2), (8, 8), (2, 1), (5, 0)]) >= 3 and grammar.add([(9, 2), (10, 10), (10, 8)]) >= 1
    role = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    for n in range(1, 5):
        for letters in itertools.product("sUauod" if n > 3 else "suaoSUAOd", repeat=n):
            rows = [(i, "user", " ") if c == "d" else (i, role[c.lower()], f"{i}" + "." * c.islower()) for i, c in enumerate(letters)]
            ways = [(e[0] + ending(j)[0], text_of(e[1]) + ending(j)[1]) for j in STATES if (e := grammar.matrix("".join(letters))[START][j])]
            assert min(ways) == cheapest(rows)[5:7]


def test_chunk_table_is_bounded_by_bytes():
    """Texts without spaces are one chunk each: long ones are not kept, short ones only up to the room."""
    from pulsekit.llm.textchunks import ChunkTable
    table = ChunkTable(lambda chunk, known: chunk.encode() * 2, room=1 << 20, longest=4096)
    for i in range(400):
        texts = pa.array([f"{i}." + "x" * 90_000] + [f"{i}.{j}." + "y" * (j * 50) for j in range(60)])
        assert table.values(texts.to_pylist()) == [t.encode() * 2 for t in texts.to_pylist()]
        held = sum(len(k) + len(v) for some in (table.now, table.old) for k, v in some.items())
        assert held < 2 * ((1 << 20) + 61 * 3 * 4096)


@pytest.mark.parametrize("size,fan", [(7, 2), (40, 3), (1000, 64)])
def test_counts_of_long_texts_from_chunk_rows(spark, size, fan):
    """Rows of chunks, composed in rounds, give the library's counts: with and without spaces, special strings, repeated texts, nulls."""
    from tokenizers import Tokenizer

    from pulsekit.llm.token_counts import count_tokens
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    r = random.Random(size)
    texts = [None, "", " ", "x" * 300, "ab12cd345ef" * 60, "deadbeef0042" * 90, "  a  b \n\n c" * 50, "\u00bd\u00b25\u00b2 5a\u00e95" * 40, "no<|endoftext|>space" * 30, "<|endoftext|>" * 9,
             " ".join("".join(r.choice("abcde123'.,é") for _ in range(r.randrange(1, 12))) for _ in range(300)), "a" + " " * 200 + "b", "don't I'll 's5 x's" * 40]
    rows = [(i, t) for i, t in enumerate(texts + texts[4:7])]
    got = count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, chunk_chars=size, fan=fan).collect()
    assert sorted((x.doc_id, x.n_tokens) for x in got) == [(i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
