"""Streams give the batch answers: one file or many, one micro-batch or one per file, in order or within the delay."""

import os
import time

import pytest
from pyspark.sql import functions as F

from pulsekit.plans.catalog import QUERIES
from pulsekit.plans.stream_catalog import STREAM_ORACLE_OF, STREAM_QUERIES
from pulsekit.streaming.io import Ending, run_to_table, run_while, upsert_latest, write_outputs
from pulsekit.streaming.late import latest, stream_late_windows, stream_top_n
from pulsekit.streaming.running import running_counts, stream_running_distinct
from pulsekit.streaming.upsert import UpsertTable
from pulsekit.streaming.processors import stream_click_cap, stream_one_to_one, stream_order_status
from tests.conftest import SF001


def same(a, b):
    b = b.select(*a.columns)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def folder_table(spark, path, files: int) -> str:
    """``events`` as a folder of ``files`` part files whose times follow each other."""
    rows = spark.read.parquet(f"{SF001}/events.parquet").orderBy("ts", "event_id").toPandas()
    os.makedirs(f"{path}/events.parquet")
    for i in range(files):
        name = f"{path}/events.parquet/part-{files - i:05d}.parquet"
        rows.iloc[i * len(rows) // files:(i + 1) * len(rows) // files].to_parquet(name, index=False, coerce_timestamps="us")
        os.utime(name, (1_700_000_000 + 10 * i,) * 2)
    return str(path)


@pytest.mark.parametrize("name", sorted(STREAM_QUERIES))
def test_one_file(spark, name):
    same(STREAM_QUERIES[name](spark, SF001), QUERIES[STREAM_ORACLE_OF[name]](spark, SF001))


@pytest.mark.parametrize("name", ["stream_hot_items_topn", "stream_uv_hourly", "stream_interval_join", "stream_reconcile", "stream_order_timeout",
                                  "stream_fail_episodes", "stream_fail_runs", "stream_click_cap_warn", "stream_hot_urls_topn", "stream_uv_running",
                                  "stream_fail_pairs"])
def test_folder_a_file_at_a_time(spark, tmp_path, name):
    sf = folder_table(spark, tmp_path, 3)
    same(STREAM_QUERIES[name](spark, sf, max_files=1), QUERIES[STREAM_ORACLE_OF[name]](spark, SF001))


@pytest.mark.parametrize("name", ["stream_pv_hourly", "stream_order_status"])
def test_many_files(spark, tmp_path, name):
    same(STREAM_QUERIES[name](spark, folder_table(spark, tmp_path, 9), max_files=1), QUERIES[STREAM_ORACLE_OF[name]](spark, SF001))


def batches(spark, path, schema, *parts):
    """A stream of one micro-batch per part."""
    path = str(path)
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).withColumn("ts", F.timestamp_seconds("ts")).coalesce(1).write.mode("append").parquet(path)
        for f in os.listdir(path):
            if f.endswith(".parquet") and os.path.getmtime(f"{path}/{f}") > 1_800_000_000 - 100_000_000 + 1000 * len(parts):
                os.utime(f"{path}/{f}", (1_500_000_000 + 10 * i,) * 2)
    read = spark.read.parquet(path).schema
    return spark.readStream.schema(read).option("maxFilesPerTrigger", 1).parquet(path)


def test_disorder_inside_the_delay(spark, tmp_path):
    """A pay comes a file before its create; both are held until the watermark passes them."""
    s = batches(spark, tmp_path / "in", "order_id long, event_type string, ts long, seq long",
                [(1, "pay", 10, 2)], [(1, "create", 8, 1)], [(2, "create", 200, 3)])
    end = Ending(spark)
    rows = stream_order_status(end.close(s, "ts", "60 seconds"), "order_id", "ts", "seq", "event_type", "15 minutes")
    got = {(r.order_id, r.create_seq, r.pay_seq, r.status) for r in run_to_table(rows, "disorder", end).collect()}
    assert got == {(1, 1, 2, "paid"), (2, 3, None, "no_pay")}


def test_click_cap_over_midnight(spark, tmp_path):
    """A late row of the day before still counts for its own day (midnight of UTC+8 is 16:00 UTC)."""
    m = 16 * 3600
    s = batches(spark, tmp_path / "in", "user long, ad string, ts long, seq long",
                [(1, "a", m - 50, 1), (1, "a", m - 40, 2)], [(1, "a", m + 5, 5)], [(1, "a", m - 30, 3), (1, "a", m - 20, 4), (1, "a", m + 9, 6)])
    end = Ending(spark)
    rows = run_to_table(stream_click_cap(end.close(s, "ts", "10 minutes"), "user", "ad", "ts", "seq", 3), "midnight", end)
    assert sorted((r.seq, r.status) for r in rows.collect()) == [(1, "pass"), (2, "pass"), (3, "warn"), (5, "pass"), (6, "pass")]


def test_one_to_one(spark, tmp_path):
    s = batches(spark, tmp_path / "in", "tx string, kind string, ts long, seq long",
                [("a", "pay", 100, 1), ("b", "pay", 100, 2), ("b", "pay", 101, 3), ("c", "receipt", 100, 4)],
                [("a", "receipt", 105, 5), ("b", "receipt", 102, 6), ("c", "pay", 104, 7), ("d", "receipt", 97, 8), ("d", "pay", 100, 9)])
    end = Ending(spark)
    rows = run_to_table(stream_one_to_one(end.close(s, "ts", "30 seconds"), "tx", "ts", "seq", "kind"), "one_to_one", end)
    got = {(r.tx, r.pay_seq, r.receipt_seq, r.status) for r in rows.collect()}
    assert got == {("a", 1, 5, "matched"), ("b", 2, 6, "matched"), ("b", 3, None, "pay_only"), ("c", None, 4, "receipt_only"),
                   ("c", 7, None, "pay_only"), ("d", 9, 8, "matched")}


def test_run_goes_on_where_it_stopped(spark, tmp_path):
    s = batches(spark, tmp_path / "in", "k long, ts long", [(1, 10)])
    where = {"out": str(tmp_path / "out"), "checkpoint": str(tmp_path / "progress")}
    assert run_to_table(s, "resume", **where).count() == 1
    batches(spark, tmp_path / "in", "k long, ts long", [(2, 20)])
    assert run_to_table(s, "resume", **where).count() == 2


def test_tagged_outputs_and_upsert(spark, tmp_path):
    a = spark.createDataFrame([(1, 5, "paid"), (2, 6, "no_pay")], "k int, v int, status string")
    b = spark.createDataFrame([(1, 9, "paid")], "k int, v int, status string")
    targets = {"paid": str(tmp_path / "paid"), "no_pay": str(tmp_path / "no_pay")}
    for epoch, batch in ((0, a), (1, b), (1, b)):  # the second epoch is replayed
        write_outputs(batch, targets, epoch)
    assert spark.read.parquet(targets["paid"]).count() == 2
    assert [(r.k, r.v) for r in upsert_latest(spark, targets["paid"], ["k"]).collect()] == [(1, 9)]


def test_many_overlaps(spark, tmp_path):
    """720 windows a row: panes are counted first, and give the batch answer over several micro-batches."""
    from pulsekit.operators.windows import window_counts
    from pulsekit.streaming.plans import stream_window_counts
    rows = [[("a", 7200 + 3 * i), ("b", 7200 + 5 * i), ("a", 7200 + 3 * i)] for i in range(3)]
    s = batches(spark, tmp_path / "in", "k string, ts long", *rows)
    end = Ending(spark)
    got = run_to_table(stream_window_counts(end.close(s, "ts", "1 minute"), "ts", "k", "1 hour", "5 seconds"), "overlaps", end)
    same(got, window_counts(spark.read.parquet(str(tmp_path / "in")), "ts", ["k"], "1 hour", "5 seconds"))


def late_log(spark, tmp_path, parts, lateness="120 seconds", **sizes):
    s = batches(spark, tmp_path / "in", "url string, ts long", *parts)
    end = Ending(spark)
    counts = stream_late_windows(end.close(s, "ts", "2 seconds"), "ts", "url", sizes.get("size", "600 seconds"), sizes.get("slide", "300 seconds"), lateness)
    return run_to_table(counts, "late", end)


def test_windows_fire_again_for_late_rows(spark, tmp_path):
    """One micro-batch a part: fired at the watermark, corrected once a late row, gone after the lateness; only windows expire, not rows."""
    log = late_log(spark, tmp_path, [
        [("a", 10), ("a", 200), ("b", 290), (None, 5)], [("a", 400)],               # watermark 398: ends 0 and 300 fire
        [("a", 250), ("a", 251), ("c", 299), ("d", 298)],                           # late for 300, on time for 600
        [("z", 500)],                                                               # watermark 498: 300 is gone
        [("a", 100), ("a", -50), ("a", -60), ("e", -1)]])                           # 600 still counts the first; the others have no window left
    got = sorted(((r.url or "", r.window_end // 1_000_000, r.cnt, -1 if r.version is None else r.version, r.kind) for r in log.collect()))
    assert got == sorted([
        ("a", 300, 2, 0, "fired"), ("a", 300, 3, 1, "late"), ("a", 300, 4, 2, "late"), ("a", 600, 6, 0, "fired"), ("a", 900, 1, 0, "fired"),
        ("b", 300, 1, 0, "fired"), ("b", 600, 1, 0, "fired"), ("", 300, 1, 0, "fired"), ("", 600, 1, 0, "fired"),
        ("c", 300, 1, 0, "late"), ("c", 600, 1, 0, "fired"), ("d", 300, 1, 0, "late"), ("d", 600, 1, 0, "fired"),
        ("z", 600, 1, 0, "fired"), ("z", 900, 1, 0, "fired"), ("a", 300, 2, -1, "dropped"), ("e", 300, 1, -1, "dropped")])


def test_no_lateness_drops_what_is_late(spark, tmp_path):
    log = late_log(spark, tmp_path, [[("a", 10)], [("a", 700)], [("a", 20), ("b", 30), ("a", 690)]], lateness="0 seconds", size="300 seconds")
    assert sorted((r.url, r.window_end // 1_000_000, r.cnt, r.kind) for r in log.collect()) == [
        ("a", 300, 1, "dropped"), ("a", 300, 1, "fired"), ("a", 900, 2, "fired"), ("b", 300, 1, "dropped")]


def test_ranks_are_revised_and_bounded(spark, tmp_path):
    """Corrections move ranks; a key that was out comes back; ties go by key; state holds n entries whatever the keys."""
    first = [("k%03d" % i, 5) for i in range(200)] + [("x", 6)] * 3 + [("y", 7)] * 2
    s = batches(spark, tmp_path / "in", "url string, ts long", first, [("t", 320)], [("y", 8), ("y", 9), ("k150", 3)], [("k150", 3), ("k150", 4), ("k150", 2)])
    end = Ending(spark)
    counts = stream_late_windows(end.close(s, "ts", "2 seconds"), "ts", "url", "300 seconds", lateness="1 hour")
    lists = run_to_table(stream_top_n(counts, "url", 3, "1 hour"), "ranked", end)
    by: dict = {}
    for r in lists.filter("window_end = 300000000").orderBy("revision", "rank").collect():
        by.setdefault(r.revision, []).append((r["rank"], r.url, r.cnt))
    assert [by[k] for k in sorted(by)][-1] == [(1, "k150", 5), (2, "y", 4), (3, "x", 3)]
    assert all(len(rows) == 3 for rows in by.values()) and len(by) >= 2
    assert sorted((r["rank"], r.url, r.cnt) for r in latest(lists, ["window_end"], "revision").filter("window_end = 300000000").collect()) == by[max(by)]


def test_best_of_many_keys_in_little_room():
    from pulsekit.streaming.late import _best
    rows = [(f"k{i % 997}", i) for i in range(5000)]
    assert _best({}, rows, 3) == [("k14", 4999), ("k13", 4998), ("k12", 4997)]


def test_running_count_with_disorder(spark, tmp_path):
    """Rows come out of order within the delay, over several micro-batches; nulls, repeats and ids of any sign; an hour's end inside."""
    rows = [[(5, 3590, 1), (5, 3500, 2), (-7, 3595, 3), (None, 3596, 4)], [(8, 3560, 5), (5, 3605, 6), (2**60, 3599, 7)],
            [(8, 3601, 8), (5, 3580, 9), (-7, 3660, 10)], [(9, 7300, 11), (5, 3000, 12)]]
    s = batches(spark, tmp_path / "in", "user long, ts long, seq long", *rows)
    end = Ending(spark)
    got = running_counts(run_to_table(stream_running_distinct(end.close(s, "ts", "60 seconds"), "ts", "user", "seq"), "running", end))
    seen: dict = {}
    want = []
    for user, ts, seq in sorted((r for part in rows for r in part if r[0] is not None and r[2] != 12), key=lambda r: r[1:]):   # 12 is behind the watermark
        seen.setdefault(ts // 3600, set()).add(user)
        want.append((seq, len(seen[ts // 3600])))
    assert sorted((r.seq, r.uv) for r in got.collect()) == sorted(want)


def test_late_requests_match_a_plain_count(spark):
    """The loads, the watermark between them and the windows, one row at a time."""
    from pulsekit.plans import stream_catalog as C
    rows, loads = C.late_requests(spark.read.parquet(f"{SF001}/events.parquet"))
    passed, want = 0, {}
    by = sorted(rows.select("load", F.unix_micros("ts").alias("us"), "url").collect())
    for load in range(loads):
        here = [(r.us, r.url) for r in by if r.load == load]
        for us, url in here:
            ends = [(us // 300_000_000 + 1 + j) * 300_000_000 for j in range(2)]
            alive = [e for e in ends if e + 60_000_000 > passed]
            for e in alive:
                cnt, late, gone = want.get((url, e), (0, -1, 0))
                want[url, e] = (cnt + 1, late + 1 if e <= passed else max(late, 0), gone)
            if not alive:
                cnt, late, gone = want.get((url, ends[-1]), (0, 0, 0))
                want[url, ends[-1]] = (cnt, late, gone + 1)
        passed = max(passed, (max(us for us, _ in here) // 1000 - 2000) * 1000) if here else passed
    got = {(r.url, int(r.end)): (r.cnt, r.corrections, r.dropped) for r in C.q_stream_hot_urls_late(spark, SF001).withColumn(
        "end", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', window_end)")).collect()}
    assert got == {k: (c, max(n, 0), g) for k, (c, n, g) in want.items()}
    assert sum(g for _, _, g in got.values()) > 0


def test_ingest_time_is_written_once(spark, tmp_path):
    """Each load has one ingest time, kept as it is when the run goes on; windows over it can be replayed."""
    from pulsekit.operators.windows import window_counts
    from pulsekit.streaming.ingest import stamp_ingest
    from pulsekit.streaming.plans import stream_window_counts
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    s = batches(spark, tmp_path / "in", "k string, ts long", [("a", 1), ("b", 2)], [("a", 3)])
    first = {(r.k, r.ts.timestamp()): r.ingest_ts for r in stamp_ingest(s, out, progress).collect()}
    batches(spark, tmp_path / "in", "k string, ts long", [("a", 4)])
    stored = stamp_ingest(s, out, progress)
    again = {(r.k, r.ts.timestamp()): r.ingest_ts for r in stored.collect()}
    assert len(again) == 4 and all(again[k] == t for k, t in first.items())
    assert len(set(first.values())) == 2 and max(first.values()) < again[max(set(again) - set(first))]
    for _ in range(2):
        end = Ending(spark)
        x = end.close(spark.readStream.schema(stored.schema).parquet(out), "ingest_ts")
        same(run_to_table(stream_window_counts(x, "ingest_ts", "k", "10 seconds", "5 seconds"), "by-ingest", end),
             window_counts(stored, "ingest_ts", ["k"], "10 seconds", "5 seconds"))


def test_wall_clock_windows(spark, tmp_path):
    """Rows count in the windows open when they come; a window is given by the first run after its end."""
    from pulsekit.streaming.ingest import stream_wall_clock_windows
    where = {"out": str(tmp_path / "out"), "checkpoint": str(tmp_path / "progress")}
    s = batches(spark, tmp_path / "in", "k string, ts long", [("a", 1), ("a", 2), (None, 3)])
    counts = stream_wall_clock_windows(s, "k", "2 seconds", "1 second")
    began = time.time()
    run_while(counts, **where, going=lambda p: p["numInputRows"] == 0, interval="0 seconds", limit=60)     # stops when the rows are in
    time.sleep(max(0.0, 2.5 - (time.time() - began)))
    rest = []

    def until_all_is_out(progress):
        rest.append(progress["sink"]["numOutputRows"] if "sink" in progress else 0)
        return spark.read.schema(counts.schema).parquet(where["out"]).count() < 4

    got = run_while(counts, **where, going=until_all_is_out, interval="0 seconds", limit=60).collect()
    assert sorted((r.k or "", r.cnt) for r in got) == [("", 1), ("", 1), ("a", 2), ("a", 2)]
    ends = sorted({r.window_end for r in got})
    assert ends[1] - ends[0] == 1_000_000 and began < ends[0] / 1e6 and ends[1] / 1e6 < time.time()


def test_an_end_that_is_not_final(spark, tmp_path):
    """Closed up to a time, stopped, started again from the same folders, more rows, closed up to another time, closed for good."""
    from pulsekit.operators.windows import window_counts
    from pulsekit.streaming.plans import stream_window_counts
    where = {"out": str(tmp_path / "out"), "checkpoint": str(tmp_path / "progress")}
    loads = [[("a", 10), ("a", 3500)], [("a", 3700), ("b", 7300)], [("b", 7900)]]
    got = []
    for load, until in zip(loads, ("1970-01-01 01:00:00", "1970-01-01 02:00:00", None), strict=True):
        s = batches(spark, tmp_path / "in", "k string, ts long", load)
        end = Ending(spark, str(tmp_path / "ends"))
        counts = stream_window_counts(end.close(s, "ts", "5 minutes"), "ts", "k", "1 hour")
        got.append(run_to_table(counts, "go-on", end, **where, until=until).count())
    assert got == [1, 2, 3]
    same(spark.read.parquet(where["out"]), window_counts(spark.read.parquet(str(tmp_path / "in")), "ts", ["k"], "1 hour"))


def test_upsert_table(spark, tmp_path):
    """Epochs replace keys, replays change nothing, unfinished epochs are not seen, snapshots keep reads short, earlier epochs can be read."""
    import glob
    table = UpsertTable(spark, str(tmp_path / "t"), "k string, v long, at long", ["k"], buckets=3, compact_every=3)

    def rows(*r):
        return spark.createDataFrame(r, "k string, v long, at long")

    def now(epoch=None):
        return sorted((r.k or "", r.v, r.at) for r in table.current(epoch).collect())

    assert now() == []
    table.upsert(rows(("a", 1, 10), ("a", 2, 9), ("b", 1, 1), (None, 5, None)), 0, order="at")
    assert now() == [("", 5, None), ("a", 1, 10), ("b", 1, 1)]
    table.upsert(rows(("a", 7, 11)), 1, order="at")
    table.upsert(rows(("a", 99, 99)), 1, order="at")                       # the epoch comes again after it was complete
    assert now() == [("", 5, None), ("a", 7, 11), ("b", 1, 1)] and now(0) == [("", 5, None), ("a", 1, 10), ("b", 1, 1)]
    rows(("a", -1, -1)).write.parquet(str(tmp_path / "t/delta/epoch=2"))   # written, not committed: a failed run
    assert now() == [("", 5, None), ("a", 7, 11), ("b", 1, 1)]
    table.upsert(rows(("b", 2, 20), ("c", 1, 1)), 2)                       # the replay writes it over; third epoch: a snapshot
    assert now() == [("", 5, None), ("a", 7, 11), ("b", 2, 20), ("c", 1, 1)]
    assert glob.glob(str(tmp_path / "t/snapshot/epoch=2/*.parquet"))
    read = table.current().inputFiles()
    assert read and not any("/delta/" in f for f in read)
    for epoch in range(3, 8):
        table.upsert(rows(("c", epoch, epoch)), epoch)
    assert now() == [("", 5, None), ("a", 7, 11), ("b", 2, 20), ("c", 7, 7)]
    again = UpsertTable(spark, str(tmp_path / "t"), "k string, v long, at long", ["k"])
    assert len(again.current().inputFiles()) < 12 and again.current().count() == 4


def test_update_mode_into_an_upsert_table(spark):
    from pulsekit.plans.stream_catalog import q_stream_pv_upsert
    same(q_stream_pv_upsert(spark, SF001), QUERIES["pv_hourly"](spark, SF001))


def test_joins_of_a_hot_key(spark, tmp_path):
    """One key with most rows, out of order within the delay over three micro-batches: pairs once each, leftovers of both sides,
    and the key's rows spread over buckets of the join."""
    import random

    from pulsekit.streaming.plans import stream_interval_join, stream_reconcile
    r = random.Random(3)
    keys = ["hot"] * 90 + [f"k{i % 9}" for i in range(30)] + [None]
    pays = [(k, i, r.randrange(0, 600)) for i, k in enumerate(keys)]
    receipts = [(k, 1000 + i, t + r.randrange(-6, 9)) for i, (k, _, t) in enumerate(pays)]

    def side(name, rows):
        rows = sorted(rows, key=lambda x: x[2] + r.randrange(0, 20))
        parts = [rows[i * len(rows) // 3:(i + 1) * len(rows) // 3] for i in range(3)]
        return batches(spark, tmp_path / name, f"tx string, {name}_id long, ts long", *parts).withColumnRenamed("ts", f"{name}_ts")

    end = Ending(spark)
    a, b = end.close(side("a", pays), "a_ts", "60 seconds"), end.close(side("b", receipts), "b_ts", "60 seconds")
    rows = run_to_table(stream_reconcile(a, b, "tx", "a_ts", "b_ts", "a_id", "b_id", "-3 seconds", "5 seconds"), "hot", end)
    pairs = {(i, j) for k, i, t in pays for m, j, u in receipts if k is not None and k == m and -3 <= u - t <= 5}
    want = [(i, j, "matched") for i, j in pairs]
    want += [(i, None, "pay_only") for _, i, _ in pays if i not in {p for p, _ in pairs}] + [(None, j, "receipt_only") for _, j, _ in receipts if j not in {q for _, q in pairs}]
    assert sorted(((x.left_id, x.right_id, x.status) for x in rows.collect()), key=repr) == sorted(want, key=repr)
    plan = stream_interval_join(a, b, "tx", "a_ts", "b_ts", "-3 seconds", "5 seconds")
    assert plan.columns == ["tx", "a_id", "a_ts", "b_id", "b_ts"]


@pytest.fixture
def state_rows(monkeypatch):
    """How many state rows the queries of a test wrote."""
    from pulsekit.streaming import io
    queries, start = [], io._start

    def started(*args, **kwargs):
        queries.append(start(*args, **kwargs))
        return queries[-1]

    monkeypatch.setattr(io, "_start", started)
    return lambda kind: sum(o["numRowsUpdated"] for q in queries for p in q.recentProgress for o in p["stateOperators"] if o["operatorName"].startswith(kind))


def test_click_cap_state_is_by_bucket(spark, tmp_path, state_rows):
    """Many users and ads, some null, rows that come twice: the answer of each, with state written per bucket and not per row."""
    rows = [(i if i % 7 else None, f"ad{i % 3}", 1000 + j, 4 * i + j) for i in range(1500) for j in range(4)]
    rows += rows[:40]
    s = batches(spark, tmp_path / "in", "user long, ad string, ts long, seq long", rows)
    end = Ending(spark, at_once=True)
    got = run_to_table(stream_click_cap(end.close(s, "ts"), "user", "ad", "ts", "seq", 3), "many", end).collect()
    by: dict = {}
    for user, ad, ts, seq in rows:
        by.setdefault((user, ad), []).append((ts, seq))
    want = [(*k, seq, "pass" if n < 2 else "warn") for k, mine in by.items() for n, (_, seq) in enumerate(sorted(mine)[:3])]
    assert sorted(map(repr, ((r.user, r.ad, r.seq, r.status) for r in got))) == sorted(map(repr, want))
    assert state_rows("transformWithState") < len(rows) / 2


def test_one_to_one_state_is_by_bucket(spark, tmp_path, state_rows):
    """Many keys over two micro-batches: rows and waiting ones stay with their key, state is written per bucket."""
    n = 6000
    s = batches(spark, tmp_path / "in", "tx long, kind string, ts long, seq long",
                [(i, "pay", 100 + i % 3, i) for i in range(n)], [(i, "receipt", 103, n + i) for i in range(0, n, 2)])
    end = Ending(spark)
    got = run_to_table(stream_one_to_one(end.close(s, "ts", "30 seconds"), "tx", "ts", "seq", "kind"), "many", end).collect()
    want = {(i, i, n + i, "matched") if i % 2 == 0 else (i, i, None, "pay_only") for i in range(n)}
    assert len(got) == n and {(r.tx, r.pay_seq, r.receipt_seq, r.status) for r in got} == want
    assert state_rows("transformWithState") < n


def test_reconcile_state_is_by_bucket(spark, tmp_path, state_rows):
    """Many row ids over two micro-batches, keys null, a row that comes twice, one without a time: leftovers once an id, state per bucket."""
    from pulsekit.streaming.plans import stream_reconcile
    n = 9000
    pays = [(i if i % 11 else None, i, 1000 + i % 50) for i in range(n)]
    receipts = [(i, 2 * n + i, 1002 + i % 50) for i in range(0, n, 2)]
    sides = [batches(spark, tmp_path / c, f"tx long, {c}_id long, ts long", rows[:len(rows) // 2], rows[len(rows) // 2:]).withColumnRenamed("ts", f"{c}_ts")
             for c, rows in (("a", [*pays, pays[1], (1, n, None)]), ("b", receipts))]
    end = Ending(spark)
    a, b = (end.close(x, f"{c}_ts", "60 seconds") for x, c in zip(sides, "ab", strict=True))
    got = run_to_table(stream_reconcile(a, b, "tx", "a_ts", "b_ts", "a_id", "b_id", "-3 seconds", "5 seconds"), "many", end).collect()
    paired = {i for i in range(0, n, 2) if i % 11}
    want = [(i, 2 * n + i, "matched") for i in paired] + [(i, None, "pay_only") for i in [*range(n), n] if i not in paired]
    want += [(None, 2 * n + i, "receipt_only") for i in range(0, n, 2) if i not in paired]
    assert sorted(((r.left_id, r.right_id, r.status) for r in got), key=repr) == sorted(want, key=repr)
    assert state_rows("transformWithState") < 2 * n
