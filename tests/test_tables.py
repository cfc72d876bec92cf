"""Versioned tables, the key index, pre-aggregates, sketches: each step's state, skipping, exactness."""

import datetime as dt
import glob
import itertools
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from tillstream.contract.queries import event_summary
from tillstream.functions.timebounds import TimeRange
from tillstream.operators import hierarchy, keyed, latest
from tillstream.operators.trailing import polled_totals
from tillstream.schemas import STOCK_LEVELS, TUMBLING_SUMMARY
from tillstream.sinks.key_index import KeyIndex
from tillstream.sinks.versioned import Commit, VersionedTable
from tillstream.streaming import progress

DAY = dt.datetime(2025, 1, 1)
SCHEMA = ("window_start timestamp, window_end timestamp, store_id string, total_transactions bigint, "
          "total_revenue decimal(12,2), unique_customers bigint")


def summary(spark, rows):
    """rows: (day offset, minute, store, transactions)"""
    return spark.createDataFrame([
        (DAY + dt.timedelta(days=d, minutes=m), DAY + dt.timedelta(days=d, minutes=m + 1), s, n, None, 1) for d, m, s, n in rows], SCHEMA)


def content(df):
    return sorted((r.window_start.day, r.window_start.minute, r.store_id, r.total_transactions) for r in df.collect())


# --- versioned tables ---

def test_readers_see_the_old_or_the_new_day_at_every_step(spark, scratch, monkeypatch):
    table = VersionedTable(spark, f"{scratch}/t", TUMBLING_SUMMARY)
    assert content(table.read()) == []
    table.merge(summary(spark, [(0, 0, "a", 1), (0, 1, "b", 2), (1, 0, "a", 3)]))
    old = content(table.read())
    new = [(1, 0, "a", 1), (1, 1, "b", 20), (1, 2, "c", 4), (2, 0, "a", 3)]
    seen, reader = [], VersionedTable(spark, f"{scratch}/t", TUMBLING_SUMMARY)
    opened = reader.read()  # opened before the merge, read after each step

    def watched(name):
        inner = getattr(VersionedTable, name)

        def step(self, *args, **kwargs):
            seen.append((content(reader.read()), content(opened)))
            out = inner(self, *args, **kwargs)
            seen.append((content(reader.read()), content(opened)))
            return out
        monkeypatch.setattr(VersionedTable, name, step)

    for name in ("_store", "publish", "_publish"):
        watched(name)
    table.merge(summary(spark, [(0, 1, "b", 20), (0, 2, "c", 4)]))
    assert [now for now, _ in seen] == [old] * 4 + [new] * 2 and all(then == old for _, then in seen)


def test_untouched_days_are_not_rewritten_and_vacuum_keeps_what_is_read(spark, scratch):
    table = VersionedTable(spark, f"{scratch}/t", TUMBLING_SUMMARY)
    table.merge(summary(spark, [(0, 0, "a", 1), (1, 0, "a", 2)]))
    first = table.current()
    for n in (5, 6):
        table.merge(summary(spark, [(1, 0, "a", n)]))
    last = table.current()
    assert last.number == 3 and last.versions["2025-01-01"] == first.versions["2025-01-01"]
    assert content(table.read(commit=first)) == [(1, 0, "a", 1), (2, 0, "a", 2)]
    assert table.vacuum(keep=2) == 1 and content(table.read(commit=table.commit_of(2))) == [(1, 0, "a", 1), (2, 0, "a", 5)]
    assert table.vacuum(keep=1) == 1 and content(table.read()) == [(1, 0, "a", 1), (2, 0, "a", 6)]
    assert content(table.read(["2025-01-02"])) == [(2, 0, "a", 6)]


def test_two_writers_one_commit(spark, scratch):
    table = VersionedTable(spark, f"{scratch}/t", TUMBLING_SUMMARY)
    table.publish(Commit(1, {}, {}))
    with pytest.raises(RuntimeError, match="another writer"):
        table.publish(Commit(1, {"x": "y"}, {}))
    assert table.current().versions == {} and not glob.glob(f"{scratch}/t/commits/.*[!c]")


def test_replayed_batches_change_nothing_and_repeats_are_decided(spark, scratch):
    table = VersionedTable(spark, f"{scratch}/t", TUMBLING_SUMMARY)
    twice = [(0, 0, "a", 7), (0, 0, "a", 3), (0, 0, None, 9)]
    rejects = table.merge(summary(spark, twice), "s", 0, order=("total_transactions",))
    assert content(table.read()) == [(1, 0, "a", 3)] and rejects.count() == 1
    assert table.merge(summary(spark, [(0, 0, "a", 99)]), "s", 0) is None
    assert content(table.read()) == [(1, 0, "a", 3)] and table.current().batches == {"s": 0}


def stock(spark, rows):
    """rows: (store, product, minute, stock)"""
    return spark.createDataFrame([(s, p, DAY + dt.timedelta(minutes=m), f"e{m}", n) for s, p, m, n in rows],
                                 "store_id string, product_id string, updated_at timestamp, event_id string, current_stock int")


@pytest.mark.parametrize("by_key", [True, False])
def test_partitions_are_merged_some_at_a_time(spark, scratch, monkeypatch, by_key):
    from tillstream.sinks import versioned
    monkeypatch.setattr(versioned, "STEP_BYTES", 1e-3, raising=False)
    part = F.format_string("%d", F.pmod(F.xxhash64(*STOCK_LEVELS.key), F.lit(4)))
    table = VersionedTable(spark, f"{scratch}/t", STOCK_LEVELS, part, by_key)
    rnd, want, stored = random.Random(1), {}, []
    inner = VersionedTable._store
    monkeypatch.setattr(VersionedTable, "_store", lambda self, rows: stored.append(rows.select("part").distinct().count()) or inner(self, rows))
    for batch in range(3):
        rows = {(f"s{rnd.randrange(5)}", f"p{rnd.randrange(30)}"): (batch, rnd.randrange(99)) for _ in range(60)}
        want |= rows
        table.merge(stock(spark, [(*k, *v) for k, v in rows.items()]), "stock", batch)
    assert {(r.store_id, r.product_id): r.current_stock for r in table.read().collect()} == {k: n for k, (_, n) in want.items()}
    assert table.read().count() == len(want) and table.current().number == 3
    assert stored == ([1] * 12 if by_key else [4] * 3)


def test_the_staged_batch_is_removed_also_if_the_merge_fails(spark, scratch, monkeypatch):
    from tillstream.sinks import versioned
    monkeypatch.setattr(versioned, "scratch_path", lambda spark, *parts: f"{scratch}/staged")
    table = VersionedTable(spark, f"{scratch}/t", TUMBLING_SUMMARY)
    rejects = table.merge(summary(spark, [(0, 0, "a", 1), (0, 1, None, 2)]))
    assert not glob.glob(f"{scratch}/staged") and rejects.count() == 1 and content(table.read()) == [(1, 0, "a", 1)]
    monkeypatch.setattr(VersionedTable, "publish", lambda self, commit: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.merge(summary(spark, [(0, 0, "a", 5)]))
    assert not glob.glob(f"{scratch}/staged") and content(table.read()) == [(1, 0, "a", 1)]


@pytest.mark.parametrize("parts", [1, 3])
def test_one_row_a_key_whatever_the_order(spark, parts):
    rows = [(i % 5, i * 7 % 11, i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, a int, b int").orderBy(F.rand(parts)).repartition(parts)
    assert {tuple(r) for r in keyed.one_per_key(df, ["k"]).collect()} == {min(r for r in rows if r[0] == k) for k in range(5)}
    by_b = {tuple(r) for r in keyed.one_per_key(df, ["k"], ["b"]).collect()}
    assert by_b == {min((r for r in rows if r[0] == k), key=lambda r: (r[2], r[1])) for k in range(5)}


# --- key index ---

def rows_scanned(df):
    """Rows that the Parquet scans of an executed frame handed on."""
    df.collect()

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if name.startswith("Scan"):
            return node.metrics().apply("numOutputRows").value()
        kids = [node.plan()] if hasattr(node, "plan") and "QueryStage" in node.getClass().getName() else []
        it = node.children().iterator()
        while it.hasNext():
            kids.append(it.next())
        return sum(walk(k) for k in kids)
    return walk(df._jdf.queryExecution().executedPlan())


def test_key_index_keeps_keys_unique_and_probes_skip_files(spark, scratch):
    index = KeyIndex(spark, f"{scratch}/k", "id", buckets=4)
    keys = lambda a, b: spark.range(a, b).select(F.concat(F.lit("t"), "id").alias("id"))
    assert index.absent(keys(0, 10), 0).count() == 10
    for batch in range(3):
        index.add(keys(batch * 1000, batch * 1000 + 1000), batch)
    assert {r.id for r in index.absent(keys(2990, 3010), 3).collect()} == {f"t{i}" for i in range(3000, 3010)}
    assert index.absent(keys(2000, 3000), 2).count() == 1000  # a replay does not meet its own keys
    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", "200")
    try:
        few = spark.createDataFrame([("t5000x",), ("t17y",)], "id string")  # sort inside the files' ranges, in none of them
        skipped = rows_scanned(index.probe(few))
        hit = rows_scanned(index.probe(keys(17, 18)))
    finally:
        spark.conf.unset("spark.sql.parquet.pushdown.inFilterThreshold")
    buckets = len({r[0] for r in few.select(index.bucket()).collect()})
    assert skipped == 0 and 0 < hit <= 1000 / 4 * 1.5 and buckets >= 1
    many = keys(0, 30_000)  # more than the lists hold: whole buckets
    assert index.absent(many, 9).count() == 27_000
    index.compact(3, f"{scratch}/s")
    assert {os.path.basename(p) for p in glob.glob(f"{scratch}/k/bucket=*/*")} == {"batch_id=-1"}
    assert index.absent(keys(0, 3005), 3).count() == 5


# --- pre-aggregates ---

MINUTES = st.integers(0, 3 * 365 * 24 * 60)


@settings(max_examples=200, deadline=None)
@given(MINUTES, MINUTES)
def test_cover_tiles_a_range(a, b):
    start, end = (dt.datetime(2023, 12, 30) + dt.timedelta(minutes=m) for m in sorted((a, b)))
    runs = hierarchy.cover(start, end)
    edge = start
    for _, x, y in sorted(runs, key=lambda r: r[1]):
        assert x == edge and x < y
        edge = y
    assert edge == end or not runs and start == end
    per_level = {}
    for level, x, y in runs:
        assert hierarchy._down(x, level) == x and hierarchy._down(y, level) == y
        per_level[level] = per_level.get(level, 0) + 1
    assert max(per_level.values(), default=0) <= 2


def test_rollups_equal_the_rows_and_reads_do_not_grow(spark, scratch):
    base = event_summary(spark, SF001)
    log = hierarchy.RollupLog(f"{scratch}/r")
    middle = dt.datetime(2024, 1, 16)
    for batch_id, rng in enumerate((TimeRange(None, middle), TimeRange(middle, None))):
        log.add(event_summary(spark, SF001, rng), batch_id)
    log.add(event_summary(spark, SF001, TimeRange(middle, None)), 1)  # a replay
    ranges = [None, TimeRange(dt.datetime(2024, 1, 2, 3, 4), dt.datetime(2024, 1, 2, 3, 9)),
              TimeRange(dt.datetime(2024, 1, 2, 3, 4), dt.datetime(2024, 1, 27, 22, 59)),
              TimeRange(dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)), TimeRange(middle, middle)]
    for _ in range(2):
        for rng in ranges:
            assert hierarchy.totals(hierarchy.nodes_of(log.read(spark), rng)).collect() == \
                hierarchy.totals_of_rows(base, rng).collect(), rng
        log.compact(spark, 2, f"{scratch}/s")
    assert {os.path.basename(p) for p in glob.glob(f"{scratch}/r/level=*/span=*/*")} == {"batch_id=-2"}
    files = lambda days: len(hierarchy.nodes_of(log._partials(spark), TimeRange(
        dt.datetime(2024, 1, 2, 3, 4), dt.datetime(2024, 1, 2, 22, 59) + dt.timedelta(days=days))).inputFiles())
    scanned = lambda days: hierarchy.nodes_of(log.read(spark), TimeRange(
        dt.datetime(2024, 1, 2, 3, 4), dt.datetime(2024, 1, 2, 22, 59) + dt.timedelta(days=days))).count()
    assert files(3) == files(24)
    assert scanned(24) < scanned(3) + 25 * 10


def test_a_reader_between_the_steps_of_a_compaction(spark, scratch):
    log = hierarchy.RollupLog(f"{scratch}/r")
    log.add(summary(spark, [(0, 0, "a", 1), (0, 1, "b", 2)]), 0)
    log.add(summary(spark, [(0, 0, "c", 4)]), 1)
    want = hierarchy.totals(hierarchy.nodes_of(log.read(spark))).collect()
    hierarchy._added(log.read(spark)).write.parquet(f"{scratch}/m")
    log._write(spark.read.parquet(f"{scratch}/m").withColumn("batch_id", F.lit(-2).cast("bigint")))  # partials still there
    assert hierarchy.totals(hierarchy.nodes_of(log.read(spark))).collect() == want


# --- trailing polls ---

@pytest.mark.parametrize("block_polls", [7, 720])
def test_polls_against_a_scan_per_poll(spark, block_polls):
    rnd = random.Random(4)
    rows = [(DAY + dt.timedelta(seconds=30 * rnd.randrange(-200, 400)), rnd.randrange(1, 9)) for _ in range(150)]
    df = spark.createDataFrame([(t, t, "s", n, None, 1) for t, n in rows], SCHEMA).withColumn("total_revenue", F.col("total_transactions") * 1.25)
    rng = TimeRange(DAY, DAY + dt.timedelta(minutes=30))
    got = polled_totals(df, rng, dt.timedelta(seconds=7), dt.timedelta(hours=1), block_polls).orderBy("poll_time").collect()
    before = None
    for i, r in enumerate(got):
        at = DAY + dt.timedelta(seconds=7 * i)
        n = sum(n for t, n in rows if at - dt.timedelta(hours=1) <= t < at)
        assert (r.poll_time, r.transactions, float(r.revenue), r.prev_transactions) == (at, n, n * 1.25, before)
        if before:
            assert float(r.transactions_change_pct) == pytest.approx(abs(n - before) / before * 100, abs=0.0501)
        before = n
    assert len(got) == 258


# --- latest state, sketches ---

def test_latest_state_ignores_order_and_repeats(spark, scratch):
    rnd = random.Random(8)
    events = [(f"s{rnd.randrange(3)}", f"p{rnd.randrange(4)}", DAY + dt.timedelta(minutes=rnd.randrange(50)), f"e{i:03d}",
               None, "sale", rnd.randrange(100), 50) for i in range(200)] + [(None, "p", DAY, "x", None, None, 1, 1)]
    schema = ("store_id string, product_id string, event_time timestamp, event_id string, product_name string, "
              "event_type string, current_stock int, reorder_level int")
    want = {}
    for e in events[:-1]:
        if e[:2] not in want or want[e[:2]][2:4] < e[2:4]:
            want[e[:2]] = e
    batch = {(r.store_id, r.product_id): (r.updated_at, r.event_id, r.current_stock, r.reorder)
             for r in latest.stock_levels(spark.createDataFrame(events + events[:50], schema)).collect()}
    assert batch == {k: (e[2], e[3], e[6], e[6] <= 50) for k, e in want.items()}
    table = VersionedTable(spark, f"{scratch}/t", STOCK_LEVELS, F.format_string("%d", F.pmod(F.xxhash64("store_id"), F.lit(2))))
    for i, part in enumerate(itertools.batched(sorted(events[:-1], key=lambda e: e[2:4]), 70)):
        table.merge(latest.stock_levels(spark.createDataFrame(list(part), schema)), "stock", i)
    assert {(r.store_id, r.product_id): r.current_stock for r in table.read().collect()} == {k: e[6] for k, e in want.items()}


def test_latency_sketches_merge(spark, scratch):
    rnd = random.Random(2)
    values = [int(rnd.expovariate(1 / 5000)) - 3 for _ in range(30_000)]
    rows = spark.createDataFrame([(i % 40, DAY, DAY + dt.timedelta(milliseconds=v)) for i, v in enumerate(values)],
                                 "batch int, a timestamp, b timestamp")
    log = progress.LatencyLog(f"{scratch}/l", "a", "b")
    for batch in range(3):
        log.save(rows.where(F.col("batch") % 3 == batch), batch)
    log.save(rows.where(F.col("batch") % 3 == 1), 1)  # a replay
    r = progress.merged_latency(log.read(spark)).first()
    values.sort()
    assert r.rows == len(values) and (r.least, r.most) == (values[0], values[-1])
    assert r.avg_latency == int(sum(values) / len(values) + 0.5)
    for got, p in ((r.p95_latency, 0.95), (r.p99_latency, 0.99)):
        rank = [i for i, v in enumerate(values) if v == got]
        assert rank and rank[0] / len(values) - progress.RANK_ERROR <= p <= (rank[-1] + 1) / len(values) + progress.RANK_ERROR
