"""Keyed state machines for streams (``transformWithState``, Row API).

Rows reach a processor in no promised order, so each is kept until the
watermark passes it; then the rows due are acted on in (event time, seq)
order, whatever micro-batches they came in.  Disorder within the watermark's
delay therefore gives the batch answer.  Absences (no pay, an episode's
close) are found when the watermark passes their time, from a timer.

A group of the state is a bucket of many keys, and map tasks pack the rows of
a group into Arrow streams: state is read and written a few times per group
and micro-batch, not per key or row.

A rule is a small class: ``step`` takes the state and a row, ``expire`` what
the watermark has passed; both give outputs and the new state.  State is
bounded by what the rule may still need and goes when it is past.  Times
cross the Python boundary as epoch microseconds.
"""

from __future__ import annotations

import itertools
import json
from datetime import date, datetime, timedelta, timezone

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from pulsekit.functions.time import local_day, to_micros

#: Groups of a stream's keys or ids.  A state call costs about as much as some hundred rows, so it is made per group, not per key.
BUCKETS = 2048
#: Bytes of rows that a map task packs at a time.
PACK_BYTES = 32 << 20


def _bucket(columns: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def _pack(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as to:
        to.write_table(rows)
    return sink.getvalue().to_pybytes()


def _packed(df: DataFrame, by: list[str]) -> DataFrame:
    """``df`` by the columns ``by`` (without nulls): those and ``rows``, the other columns of some rows as an Arrow stream."""
    def some(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(batches)
        t = t.cast(pa.schema([f.with_nullable(True) for f in t.schema]))   # it varies by micro-batch; packed rows must be alike
        t = t.take(pc.sort_indices(t, sort_keys=[(c, "ascending") for c in by])).combine_chunks()
        new = np.zeros(max(t.num_rows - 1, 0), dtype=bool)
        for c in by:
            at = t.column(c).to_numpy()
            new |= at[1:] != at[:-1]
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), t.num_rows]
        rest = t.drop_columns(by)
        rows = pa.array([_pack(rest.slice(a, b - a)) for a, b in itertools.pairwise(edges)], pa.binary())
        return pa.RecordBatch.from_arrays([*(t.column(c).take(edges[:-1]).combine_chunks() for c in by), rows], [*by, "rows"])

    def pack(batches):
        held, size = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                size += b.nbytes
            if size >= PACK_BYTES:
                yield some(held)
                held, size = [], 0
        if held:
            yield some(held)

    return df.mapInArrow(pack, T.StructType([*(df.schema[c] for c in by), T.StructField("rows", T.BinaryType())]))


class _Held(StatefulProcessor):
    """Packed rows of a group that wait for the watermark, each with its time in the column ``us``."""

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "rows binary")
        self.settled = set()

    def reach(self, key) -> int:
        """How far (µs) the watermark must pass a row's time for it to be due."""
        return 0

    def hold(self, key, tables: list[pa.Table]) -> None:
        tables = [t for t in tables if t.num_rows]
        if any(t.column("us").null_count for t in tables):
            raise ValueError("rows must have a time")
        if tables:
            self.rows.appendList([(_pack(t),) for t in tables])
            self._wake(min(pc.min(t.column("us")).as_py() for t in tables) + self.reach(key))

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(us // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        if (key, passed) in self.settled:   # another timer of the group, of the same micro-batch
            return
        self.settled.add((key, passed))
        due = rest = None
        if self.rows.exists():
            t = pa.concat_tables([_unpack(r[0]) for r in self.rows.get()])
            late = pc.less(t.column("us"), passed - self.reach(key))
            due, rest = t.filter(late), t.filter(pc.invert(late))
            if due.num_rows and rest.num_rows:
                self.rows.put([(_pack(rest),)])
            elif due.num_rows:
                self.rows.clear()
        wake = yield from self.act(key, passed, zip(*(c.to_pylist() for c in due.columns), strict=True) if due else ())
        if rest:
            wake.append(pc.min(rest.column("us")).as_py() + self.reach(key))
        if wake:
            self._wake(max(min(wake), passed))

    def act(self, key, passed: int, due) -> list[int]:
        """Yields outputs for the rows that are due; returns further times to wake at."""
        raise NotImplementedError

    def close(self) -> None:
        pass


def _unpack(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(rows).read_all()


class EventTimeRule(_Held):
    """Holds rows until the watermark passes them, then acts in event order, key by key.

    Grouped by a bucket of the keys; a row is keys, us, seq, kind.  ``held``
    has a row per key with a state: the keys and the state.
    """

    def __init__(self, rule, keys: T.StructType):
        self.rule, self.keys = rule, keys

    def init(self, handle) -> None:
        super().init(handle)
        self.held = handle.getListState("held", T.StructType([*self.keys, T.StructField("state", T.StringType())]))

    def handleInputRows(self, key, rows, timerValues):
        self.hold(key, [_unpack(r.rows) for r in rows])
        return iter(())

    def act(self, key, passed, due):
        before = {tuple(r)[:-1]: r[-1] for r in self.held.get()} if self.held.exists() else {}
        by_key: dict[tuple, list[tuple]] = {k: [] for k in before}
        n = len(self.keys)
        for row in due:
            by_key.setdefault(row[:n], []).append(row[n:])
        after, wake = {}, []
        for k, mine in by_key.items():
            state, names = json.loads(before[k]) if k in before else None, dict(zip(self.rule.keys, k, strict=True))
            for row in sorted(mine):
                for out in self.rule.step(state, *row):
                    yield Row(**names, **out)
                state = self.rule.state
            if state is not None:
                for out in self.rule.expire(state, passed):
                    yield Row(**names, **out)
                state = self.rule.state
            if state is not None:
                after[k] = json.dumps(state)
                wake.append(self.rule.wakes(state))
        if after != before:
            self.held.clear()
            if after:
                self.held.appendList([(*k, state) for k, state in after.items()])
        return wake


class _Rule:
    """``step`` and ``expire`` yield output columns and leave the new state in ``self.state``."""

    def __init__(self, keys: list[str], span_us: int = 0):
        self.keys, self.span, self.state = keys, span_us, None

    def wakes(self, state) -> int | None:
        """The time (µs) that the watermark must pass for ``expire`` to have work."""
        return state["us"] + self.span

    def expire(self, state, passed):
        self.state = None if self.wakes(state) < passed else state
        return iter(())


class OrderStatus(_Rule):
    """T4: create, then pay within the span (inclusive), else ``no_pay`` / ``payed_timeout``; a newer create replaces one."""

    out = "create_us long, pay_us long, create_seq long, pay_seq long, status string"

    def _row(self, state=None, us=None, seq=None, status=None):
        return {"create_us": state and state["us"], "pay_us": us, "create_seq": state and state["seq"], "pay_seq": seq, "status": status}

    def step(self, state, us, seq, kind):
        if state and us > state["us"] + self.span:
            yield self._row(state, status="no_pay")
            state = None
        if kind == "create":
            state = {"us": us, "seq": seq}
        elif kind == "pay":
            yield self._row(state, us, seq, "paid" if state else "payed_timeout")
            state = None
        self.state = state

    def expire(self, state, passed):
        self.state = state
        if self.wakes(state) < passed:
            yield self._row(state, status="no_pay")
            self.state = None


class ClickCap(_Rule):
    """Per local day (``kind``) pass clicks while ``n == 1 or n < max``, warn once at ``max(2, max)``.

    A day's count goes when the watermark is past the day in every zone.
    """

    out = "day string, ts_us long, seq long, status string"

    def __init__(self, keys, max_clicks):
        super().__init__(keys)
        self.max_clicks = max_clicks

    def step(self, state, us, seq, kind):
        state = state or {}
        n = state[kind] = state.get(kind, 0) + 1
        if n == 1 or n < self.max_clicks:
            yield {"day": kind, "ts_us": us, "seq": seq, "status": "pass"}
        elif n == max(2, self.max_clicks):
            yield {"day": kind, "ts_us": us, "seq": seq, "status": "warn"}
        self.state = state

    def _end(self, day: str) -> int:
        return int((datetime.combine(date.fromisoformat(day), datetime.min.time(), timezone.utc) + timedelta(days=2)).timestamp()) * 1_000_000

    def wakes(self, state):
        return min(map(self._end, state))

    def expire(self, state, passed):
        self.state = {d: n for d, n in state.items() if self._end(d) >= passed} or None
        return iter(())


class FailPairs(_Rule):
    """A fail whose previous row is a fail at most the span away."""

    out = "first_us long, last_us long, first_seq long, last_seq long"

    def step(self, state, us, seq, kind):
        if state and kind == "fail" and us - state["us"] <= self.span:
            yield {"first_us": state["us"], "last_us": us, "first_seq": state["seq"], "last_seq": seq}
        self.state = {"us": us, "seq": seq} if kind == "fail" else None


class FailEpisodes(_Rule):
    """The first fail opens an episode that closes the span later; two fails or more alert, a success before cancels."""

    out = "first_us long, last_us long, n_fails long"

    def _alert(self, state):
        if state["n"] >= 2:
            yield {"first_us": state["us"], "last_us": state["last"], "n_fails": state["n"]}

    def step(self, state, us, seq, kind):
        if state and us > state["us"] + self.span:
            yield from self._alert(state)
            state = None
        if kind != "fail":
            state = None
        elif state:
            state = state | {"last": us, "n": state["n"] + 1}
        else:
            state = {"us": us, "last": us, "n": 1}
        self.state = state

    def expire(self, state, passed):
        self.state = state
        if self.wakes(state) < passed:
            yield from self._alert(state)
            self.state = None


class FailRuns(_Rule):
    """``n`` fails in a row that span less than ``span``; overlapping runs all count."""

    out = "first_us long, last_us long, first_seq long, last_seq long, n_events int"

    def __init__(self, keys, span_us, n):
        super().__init__(keys, span_us)
        self.n = n

    def step(self, state, us, seq, kind):
        run = [*(state["run"] if state else []), [us, seq]][-self.n:] if kind == "fail" else []
        if len(run) == self.n and us - run[0][0] < self.span:
            yield {"first_us": run[0][0], "last_us": us, "first_seq": run[0][1], "last_seq": seq, "n_events": self.n}
        self.state = {"us": us, "run": run} if run else None


class FollowedBy(_Rule):
    """Each ``create`` pairs with the next ``pay`` less than the span later, else it times out."""

    out = "first_us long, first_seq long, then_us long, then_seq long, status string"

    def step(self, state, us, seq, kind):
        waiting = state["waiting"] if state else []
        if kind == "pay":
            for a, s in waiting:
                hit = us - a < self.span
                yield {"first_us": a, "first_seq": s, "then_us": us if hit else None, "then_seq": seq if hit else None,
                       "status": "match" if hit else "timeout"}
            waiting = []
        elif kind == "create":
            waiting = [*waiting, [us, seq]]
        self.state = {"waiting": waiting} if waiting else None

    def wakes(self, state):
        return state["waiting"][0][0] + self.span

    def expire(self, state, passed):
        for a, s in state["waiting"]:
            if a + self.span < passed:
                yield {"first_us": a, "first_seq": s, "then_us": None, "then_seq": None, "status": "timeout"}
        waiting = [w for w in state["waiting"] if w[0] + self.span >= passed]
        self.state = {"waiting": waiting} if waiting else None


class OneToOne(_Rule):
    """Pays and receipts of one key pair off one to one, each pay with the earliest receipt left in its bounds."""

    out = "pay_us long, pay_seq long, receipt_us long, receipt_seq long, status string"

    def __init__(self, keys, lower_us, upper_us):
        super().__init__(keys)
        self.low, self.high = lower_us, upper_us

    def _reach(self, kind):
        return max(self.high, 0) if kind == "pay" else max(-self.low, 0)

    def step(self, state, us, seq, kind):
        waiting = state["waiting"] if state else []
        for i, (u, s, k) in enumerate(waiting):
            gap = u - us if kind == "pay" else us - u
            if k != kind and self.low <= gap <= self.high:
                pay, receipt = ((us, seq), (u, s)) if kind == "pay" else ((u, s), (us, seq))
                yield {"pay_us": pay[0], "pay_seq": pay[1], "receipt_us": receipt[0], "receipt_seq": receipt[1], "status": "matched"}
                waiting = waiting[:i] + waiting[i + 1:]
                break
        else:
            waiting = [*waiting, [us, seq, kind]]
        self.state = {"waiting": waiting} if waiting else None

    def wakes(self, state):
        return min(u + self._reach(k) for u, _, k in state["waiting"])

    def expire(self, state, passed):
        left = []
        for u, s, k in state["waiting"]:
            if u + self._reach(k) >= passed:
                left.append([u, s, k])
            elif k == "pay":
                yield {"pay_us": u, "pay_seq": s, "receipt_us": None, "receipt_seq": None, "status": "pay_only"}
            else:
                yield {"pay_us": None, "pay_seq": None, "receipt_us": u, "receipt_seq": s, "status": "receipt_only"}
        self.state = {"waiting": left} if left else None


class Leftovers(_Held):
    """Pairs as they come (told by their left row), and a row itself when its time is up without one.

    Grouped by side and a bucket of the row ids; a row is id, key, us, paired,
    other_us, other_id.  State: rows and which ids had a pair, both until the
    row's time is up.  Rows without a time are left over at once.
    """

    out = "left_us long, left_id long, right_us long, right_id long, status string"

    def __init__(self, key: str, sides: dict[bool, tuple[int, str]]):
        self.key, self.sides = key, sides

    def reach(self, key):
        return max(self.sides[key[0]][0], 0)

    def _out(self, is_left, id_, value, us, other=(None, None), status=None):
        left, right = ((us, id_), other) if is_left else (other, (us, id_))
        return Row(**{self.key: value}, left_us=left[0], left_id=left[1], right_us=right[0], right_id=right[1], status=status or self.sides[is_left][1])

    def handleInputRows(self, key, rows, timerValues):
        tables = [_unpack(r.rows) for r in rows]
        for t in tables:
            now = pc.or_(pc.and_(t.column("paired"), key[0]), pc.is_null(t.column("us")))
            for id_, value, us, paired, *other in zip(*(c.to_pylist() for c in t.filter(now).columns), strict=True):
                yield self._out(key[0], id_, value, us, other, "matched" if paired else None)
        self.hold(key, [t.filter(pc.is_valid(t.column("us"))).drop_columns(["other_us", "other_id"]) for t in tables])

    def act(self, key, passed, due):
        due = list(due)
        paired = {id_ for id_, _, _, yes in due if yes}
        for id_, (value, us) in {id_: (value, us) for id_, value, us, yes in due if not yes}.items():
            if id_ not in paired:
                yield self._out(key[0], id_, value, us)
        return []


def leftovers(rows: DataFrame, sides: dict[bool, tuple[int, str]], key: str = "key", buckets: int = BUCKETS) -> DataFrame:
    """(side, id, key, us, paired, other_us, other_id) → pairs and leftovers; ``sides`` (True: left): reach in µs and status."""
    kind = rows.schema[key]
    schema = T.StructType([kind, *T.StructType.fromDDL(Leftovers.out).fields])
    x = rows.select("side", _bucket(["id"], buckets).alias("bucket"), "id", key, "us", "paired", "other_us", "other_id")
    return _packed(x, ["side", "bucket"]).groupBy("side", "bucket").transformWithState(Leftovers(key, sides), schema, "append", "EventTime")


def _run(df: DataFrame, key, ts: str, seq: str, kind: Column, rule, buckets: int = BUCKETS) -> DataFrame:
    """The rule's output per key.  Filter rows before the watermark, not after it (see ``streaming.io``)."""
    names = [key] if isinstance(key, str) else list(key)
    keys = [F.col(k).alias(f"k{i}") for i, k in enumerate(names)]
    x = df.select(_bucket(names, buckets).alias("bucket"), *keys, F.unix_micros(F.col(ts)).alias("us"), F.col(seq).cast("long").alias("seq"), kind.alias("kind"))
    schema = T.StructType([*(df.schema[k] for k in names), *T.StructType.fromDDL(rule.out).fields])
    held = T.StructType(x.schema.fields[1:len(names) + 1])
    return _packed(x, ["bucket"]).groupBy("bucket").transformWithState(EventTimeRule(rule, held), schema, "append", "EventTime")


def stream_order_status(orders: DataFrame, key: str, ts: str, seq: str, event_type: str, within="15 minutes") -> DataFrame:
    """Watermarked create and pay rows → order status rows (times in epoch µs)."""
    return _run(orders, key, ts, seq, F.col(event_type), OrderStatus([key], to_micros(within)))


def stream_click_cap(clicks: DataFrame, user: str, ad: str, ts: str, seq: str, max_clicks: int = 100,
                     zone: str = "Asia/Shanghai") -> DataFrame:
    """Watermarked clicks → pass and warn rows, tagged by ``status``."""
    return _run(clicks, [user, ad], ts, seq, local_day(ts, zone).cast("string"), ClickCap([user, ad], max_clicks))


def stream_fail_pairs(logins: DataFrame, key: str, ts: str, seq: str, event_type: str, interval="2 seconds") -> DataFrame:
    return _run(logins, key, ts, seq, F.col(event_type), FailPairs([key], to_micros(interval)))


def stream_fail_episodes(logins: DataFrame, key: str, ts: str, seq: str, event_type: str, interval="2 seconds") -> DataFrame:
    return _run(logins, key, ts, seq, F.col(event_type), FailEpisodes([key], to_micros(interval)))


def stream_fail_runs(logins: DataFrame, key: str, ts: str, seq: str, event_type: str, n: int = 5, within="5 seconds") -> DataFrame:
    return _run(logins, key, ts, seq, F.col(event_type), FailRuns([key], to_micros(within), n))


def stream_followed_by(orders: DataFrame, key: str, ts: str, seq: str, event_type: str, within="15 minutes") -> DataFrame:
    """Watermarked create and pay rows → ``match`` and ``timeout`` rows."""
    return _run(orders, key, ts, seq, F.col(event_type), FollowedBy([key], to_micros(within)))


def stream_one_to_one(both: DataFrame, key: str, ts: str, seq: str, kind: str, lower="-3 seconds", upper="5 seconds") -> DataFrame:
    """A watermarked union of ``pay`` and ``receipt`` rows → matched pairs and the rows without a partner."""
    return _run(both, key, ts, seq, F.col(kind), OneToOne([key], to_micros(lower), to_micros(upper)))
