"""Repair of conversations: what is wrong with each, and the cheapest edits that make it alternate.

The repaired roles are an optional system row, then user and assistant in
turns.  Each row is one symbol of role and fault; the sequences of all
conversations share a grammar (see :mod:`repair_grammar`), each rule of which
is solved once.

1. Equal rows of a conversation collapse with their number, so that rows are
   unique; the first of each (role, text) is found by an aggregate and a join
   on unique rows.
2. Rows are range-partitioned by (conversation, turn, role, text): one
   conversation may spread over many tasks.  Each task cuts its runs into
   blocks of at most ``block_rows`` rows (or ``block_bytes`` of text).
3. Distinct sequences of blocks give the grammar, in rounds: pairs are
   counted by Spark, the most frequent become rules.
4. Each distinct sequence is solved once, from its rules.
5. A conversation is a walk over its blocks in order.  For each state it
   keeps the cost, the edits not shared by all states, and a running hash of
   the repaired text, so a conversation of any length needs the room of one
   block and of its own edits.
"""

from __future__ import annotations

import hashlib
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.llm.common import written
from pulsekit.llm.repair_grammar import START, STATES, TERMINALS, Grammar, better, ending, text_of

SPACE = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}
_ROLES = ("user", "assistant")


def _stripped(text: str) -> Column:
    return F.rtrim(F.col(text), F.lit(SPACE))


def marked_rows(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text, n → distinct rows with ``letter`` (of the first of the n) and ``fault``.

    ``fault`` is the first that applies: blank, duplicate, truncated, or
    empty.  The other n - 1 rows are blank or duplicates.
    """
    rows = written(rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n")), "turns")
    digest = F.sha2(F.col("text"), 256)
    first = (rows.filter(_stripped("text") != "").groupBy("conv", "role", digest.alias("digest")).agg(F.min(F.struct("turn")).alias("t"))
             .select(F.col("conv").alias("conv_1"), F.col("role").alias("role_1"), "digest", F.col("t.turn").alias("turn_1"), F.lit(True).alias("is_first")))
    same = F.col("conv").eqNullSafe(F.col("conv_1")) & F.col("turn").eqNullSafe(F.col("turn_1")) & (F.col("role") == F.col("role_1")) & (digest == F.col("digest"))
    both = rows.join(first, same, "left")
    ended = F.right(_stripped("text"), F.lit(1)).isin(".", "!", "?")
    fault = (F.when(_stripped("text") == "", "blank").when(F.col("is_first").isNull(), "duplicate")
             .when(~ended, "truncated").otherwise(""))
    both = both.withColumn("fault", fault).withColumn("initial", F.substring("role", 1, 1))
    both = both.withColumn("group", F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o"))
    letter = (F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper("group")).otherwise(F.col("group")))
    return both.select("conv", "turn", "role", "text", "n", "fault", "initial", letter.alias("letter"))


class _Block:
    """Rows of one conversation that follow each other."""

    def __init__(self, conv):
        self.conv, self.letters, self.kept, self.size = conv, [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn, role, text, n, fault, initial, letter):
        """``n`` equal rows, the first with ``letter``, the others to go."""
        self.letters.append(letter + "d" * (n - 1))
        if letter != "d":
            self.kept.append((role, text))
            self.size += len(text)
        self.size += n
        self.blank += n if fault == "blank" else 0
        self.duplicate += n if fault == "duplicate" else 0 if fault == "blank" else n - 1
        self.truncated += fault == "truncated"
        self.illegal += (n - 1) + (self.last is not None and self.last + initial not in _LEGAL)
        if self.last is None:
            self.first = initial
        if turn is not None:
            self.turns += self.high is None or turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.last = initial

    def row(self, part: int, no: int) -> dict:
        return {"conv": self.conv, "part": part, "no": no, "seq": "".join(self.letters),
                "roles": [r for r, _ in self.kept], "texts": [t for _, t in self.kept], "blank": self.blank, "duplicate": self.duplicate,
                "truncated": self.truncated, "illegal": self.illegal, "first": self.first, "last": self.last, "turns": self.turns,
                "low": self.low, "high": self.high}


_BLOCK = ("part int, no long, seq string, roles array<string>, texts array<string>, blank long, duplicate long, "
          "truncated long, illegal long, first string, last string, turns long, low long, high long")


def _batches(rows, types: dict, limit: int = 8 << 20):
    """Record batches of about ``limit`` bytes of ``(size, row)``; ``types`` of the columns may be filled until the first row comes."""
    held, size = [], 0

    def batch():
        return pa.RecordBatch.from_pylist(held, pa.schema(list(types.items())))

    for n, r in rows:
        held.append(r)
        size += n + 200
        if size >= limit:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _types(ddl: str, conv=None) -> dict:
    """Arrow types of the columns of ``ddl``, after that of the conversation."""
    known = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}
    return {"conv": conv} | {name: known[kind] for name, kind in (c.split(" ") for c in ddl.split(", "))}


def _schema(first: T.StructField, rest: str) -> T.StructType:
    return T.StructType([T.StructField("conv", first.dataType), *T.StructType.fromDDL(rest).fields])


def blocks_of(marked: DataFrame, block_rows: int, block_bytes: int) -> DataFrame:
    """Runs of each conversation's rows in order (turn, role, text; null turns first)."""
    schema = _schema(marked.schema["conv"], _BLOCK)
    order = ["conv", "turn", "role", "text"]

    def cut(batches):
        part, types = TaskContext.get().partitionId(), _types(_BLOCK)

        def rows():
            no, block = 0, None
            for b in batches:
                types["conv"] = b.schema.field("conv").type
                for r in zip(*(b.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "n", "fault", "initial", "letter")), strict=True):
                    conv, turn, role, text, n, fault, initial, letter = r
                    while n > 0:
                        if block is not None and (block.conv != conv or sum(map(len, block.letters)) >= block_rows or block.size >= block_bytes):
                            yield block.size, block.row(part, no)
                            no, block = no + 1, None
                        block = block or _Block(conv)
                        some = min(n, block_rows)
                        block.add(turn, role, text, some, fault, initial, letter)
                        n -= some
                        if letter != "d":       # the copies that are left repeat a row seen
                            letter, fault = "d", "duplicate"
            if block is not None:
                yield block.size, block.row(part, no)

        return _batches(rows(), types)

    parts = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return marked.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(cut, schema)


def grammar_of(sequences: DataFrame, rounds: int, rules_a_round: int, least: int) -> Grammar:
    """Re-Pair over the distinct sequences of ``seq``; at most ``rounds * rules_a_round`` rules, for pairs that occur ``least`` times or more."""
    grammar = Grammar()
    for _ in range(rounds):
        def pairs(batches):
            for b in batches:
                left, right, count = [], [], {}
                for letters in b.column(0).to_pylist():
                    symbols, i = grammar.parse(letters), 0
                    while i + 1 < len(symbols):
                        p = symbols[i], symbols[i + 1]
                        count[p] = count.get(p, 0) + 1
                        i += 2 if p[0] == p[1] and i + 2 < len(symbols) and symbols[i + 2] == p[0] else 1
                for a, c in count:
                    left.append(a)
                    right.append(c)
                yield pa.RecordBatch.from_pydict({"a": pa.array(left, pa.int32()), "b": pa.array(right, pa.int32()),
                                                  "n": pa.array(list(count.values()), pa.int64())})

        counted = sequences.select("seq").mapInArrow(pairs, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        best = counted.filter(F.col("n") >= least).orderBy(F.desc("n"), "a", "b").limit(rules_a_round).collect()
        if not best:
            break
        grammar.add([(r["a"], r["b"]) for r in best])
    return grammar


def solved(sequences: DataFrame, grammar: Grammar) -> DataFrame:
    """The matrix of each distinct sequence, row by row: ``costs`` (null: no way) and ``audits``."""
    ddl = "seq string, costs array<long>, audits array<string>"

    def solve(batches):
        types = _types(ddl)
        del types["conv"]

        def rows():
            for b in batches:
                for letters in b.column(0).to_pylist():
                    entries = [e for row in grammar.matrix(letters) for e in row]
                    texts = [e and text_of(e[1]) for e in entries]
                    yield 16 * len(letters), {"seq": letters, "costs": [e and e[0] for e in entries], "audits": texts}
        return _batches(rows(), types)

    return sequences.select("seq").mapInArrow(solve, ddl)


class _Walk:
    """The best repairs of one conversation so far, one for each state."""

    def __init__(self):
        self.shared: list[str] = []
        self.at = [(0, "", hashlib.sha256()), None, None, None]
        self.held = None
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.low = self.high = self.last = None

    def _ways(self, block):
        """For each state after ``block``: cost, edits and the state before."""
        out = []
        for j in STATES:
            best = None
            for k in STATES:
                cost = block["costs"][4 * k + j]
                if self.at[k] is not None and cost is not None:
                    way = (self.at[k][0] + cost, self.at[k][1] + block["audits"][4 * k + j], k)
                    best = way if best is None or way[:2] < best[:2] else best
            out.append(best)
        return out

    def _hash(self, way, j: int, block, last: bool):
        """The running hash after a way through a block to state j."""
        k = way[2]
        digest = self.at[k][2] if last else self.at[k][2].copy()
        state, rows, lines = k, iter(zip(block["roles"], block["texts"], strict=True)), []
        kept = iter(block["seq"])
        for edit in block["audits"][4 * k + j]:
            if edit == "I":
                role, text = _ROLES[state == 2], ""
            else:
                row = next(rows) if next(kept) != "d" else None
                if edit == "D":
                    continue
                role, text = row
                role = _ROLES[state == 2] if edit == "R" else role
            lines.append(("\n" if state != START else "") + role + ":" + text)
            state = {"s": 1, "u": 2, "a": 3}[role[:1]]
        digest.update("".join(lines).encode())
        return digest

    def add(self, block):
        if self.held is not None:
            self._step()
        self.held = block
        for c in ("blank", "duplicate", "truncated", "illegal", "turns"):
            self.counts[c] += block[c]
        if self.last is not None:
            self.counts["illegal"] += self.last + block["first"] not in _LEGAL
        if block["low"] is not None:
            self.counts["turns"] -= self.high is not None and self.high == block["low"]
            self.low = block["low"] if self.low is None else self.low
            self.high = block["high"]
        self.last = block["last"]

    def _step(self):
        ways = self._ways(self.held)
        after = [way and (way[0], way[1], self._hash(way, j, self.held, last=False)) for j, way in enumerate(ways)]
        same = commonprefix([a[1] for a in after if a])
        if same:
            self.shared.append(same)
            after = [a and (a[0], a[1][len(same):], a[2]) for a in after]
        self.at = after

    def result(self, conv) -> dict:
        ways, best = self._ways(self.held), None
        for j, way in enumerate(ways):
            if way is not None:
                cost, more = ending(j)
                got = (way[0] + cost, way[1] + more, j)
                best = got if best is None or got[:2] < best[:2] else best
        cost, audit, j = best
        digest = self._hash(ways[j], j, self.held, last=True)
        for at in range(len(ending(j)[1])):
            state = j if at == 0 else 2
            digest.update((("\n" if state != START else "") + _ROLES[state == 2] + ":").encode())
        gaps = self.high - self.low + 1 - self.counts["turns"] if self.low is not None else 0
        c = self.counts
        return {"conv": conv, "gaps": gaps if gaps < 1 << 63 else None, "blank": c["blank"], "duplicate": c["duplicate"], "truncated": c["truncated"],
                "illegal": c["illegal"], "cost": cost, "audit": "".join(self.shared) + audit, "repaired_sha256": digest.hexdigest()}


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def walked(blocks: DataFrame) -> DataFrame:
    """One row per conversation from its solved blocks."""
    schema = _schema(blocks.schema["conv"], _RESULT)

    def walk(batches):
        types = _types(_RESULT)

        def rows():
            conv, now = None, None
            for b in batches:
                types["conv"] = b.schema.field("conv").type
                for block in b.to_pylist():
                    if now is not None and block["conv"] != conv:
                        r = now.result(conv)
                        yield len(r["audit"]), r
                        now = None
                    conv, now = block["conv"], now or _Walk()
                    now.add(block)
            if now is not None:
                r = now.result(conv)
                yield len(r["audit"]), r
        return _batches(rows(), types)

    return blocks.repartition("conv").sortWithinPartitions("conv", "part", "no").mapInArrow(walk, schema)


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: Column | None = None,
             block_rows: int = 2048, block_bytes: int = 1 << 20, rounds: int = 16, rules_a_round: int = 256, least: int = 8,
             broadcast_bytes: int = 16 << 20) -> DataFrame:
    """One row per value of ``conv``: its faults, the cheapest repair's edits and the digest of the repaired text.

    Returns conv, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256.  ``copies`` is the number of adjacent copies of each row
    (default 1; 0: the row is left out, but its conversation stays).

    Null roles and texts are taken as one space.  Null turns come first.
    Rows of one turn are ordered by role, then text; equal rows follow each
    other and all but one are duplicates.  A conversation without rows has
    zeros, an empty audit and the digest of an empty text; null is a
    conversation like any other.  A span of turns that does not fit a long
    gives null gaps.  Other columns are not read.  An empty table gives none.
    """
    n = F.lit(1) if copies is None else copies
    base = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text), F.lit(" ")).alias("text"), n.cast("long").alias("n"))
    marked = written(marked_rows(base.filter("n > 0")), "marked")
    blocks = written(blocks_of(marked, block_rows, block_bytes), "blocks")
    sequences = written(blocks.select("seq").distinct(), "sequences")
    grammar = grammar_of(sequences, rounds, rules_a_round, least)
    answers = written(solved(sequences, grammar), "solved")
    if (answers.agg(F.sum(16 * F.length("seq") + 400)).first()[0] or 0) <= broadcast_bytes:
        answers = F.broadcast(answers)
    found = walked(blocks.join(answers, "seq"))
    everyone = base.select("conv").distinct()
    empty = F.sha2(F.lit(""), 256)
    out = everyone.join(found.withColumnRenamed("conv", "c"), everyone["conv"].eqNullSafe(F.col("c")), "left")
    zero = F.lit(0).cast("long")
    gaps = F.when(F.col("audit").isNull(), zero).otherwise(F.col("gaps"))
    return out.select(F.col("conv").alias(conv), gaps.alias("gaps"), *(F.coalesce(F.col(c), zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
