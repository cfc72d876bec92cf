"""Streaming semantics: late data (FIXTURES §4), stream = batch, replay."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tillstream.functions.timebounds import TimeRange
from tillstream.schemas import REQUIRED

from tillstream.operators import windows
from tillstream.sources.decode import transactions_from_messages
from tillstream.sources.streams import text_stream
from tillstream.streaming import jobs
from tillstream.schemas import TRANSACTIONS_SUMMARY, TUMBLING_SUMMARY
from tillstream.streaming.progress import processing_latency, read_progress, stream_progress

FILES = [
    [("a", "00:00:05", 1.0), ("b", "00:00:40", 2.0)],
    [("c", "00:10:00", 3.0)],
    [("late", "00:00:10", 9.0), ("ok", "00:09:30", 4.0)],
    [("z", "01:00:00", 5.0)],
]


def _msg(tid, hms, amount):
    return json.dumps({"transaction_id": tid, "timestamp": f"2025-01-01T{hms}", "store_id": "s",
                       "customer_id": "c", "total_amount": amount, "final_amount": amount})


def _write_files(folder, files):
    """One file per micro-batch, modification times in file order."""
    os.makedirs(folder)
    now = time.time() - 1000
    for i, rows in enumerate(files):
        p = os.path.join(folder, f"part-{i:03d}.txt")
        with open(p, "w") as fh:
            fh.write("\n".join(_msg(*r) for r in rows) + "\n")
        os.utime(p, (now + 10 * i, now + 10 * i))


def _run(spark, scratch, files, build, contract=TUMBLING_SUMMARY):
    _write_files(f"{scratch}/in", files)
    paths = jobs.StreamPaths(scratch)
    raw = text_stream(spark, f"{scratch}/in", max_files_per_trigger=1)
    tx = transactions_from_messages(raw, fields=REQUIRED["transactions"])
    jobs.catch_up(build(tx), paths, contract, "q")
    out = spark.read.parquet(paths.table(contract.name))
    return {(str(r.window_start)[11:19], r.total_transactions, float(r.total_revenue))
            for r in out.collect()}, read_progress(spark, paths.progress(contract.name))


def test_late_row_counted_when_watermark_not_yet_past(spark, scratch):
    got, _ = _run(spark, scratch, FILES, lambda tx: windows.store_tumbling_summary(tx))
    assert got == {("00:00:00", 3, 12.0), ("00:09:00", 1, 4.0), ("00:10:00", 1, 3.0)}


def test_sliding_windows_late_sequence(spark, scratch):
    got, _ = _run(spark, scratch, FILES, lambda tx: windows.store_window_summary(tx), TRANSACTIONS_SUMMARY)
    assert got == {("23:59:30", 2, 10.0), ("00:00:00", 3, 12.0), ("00:00:30", 1, 2.0),
                   ("00:09:00", 1, 4.0), ("00:09:30", 2, 7.0), ("00:10:00", 1, 3.0)}


def test_late_row_dropped_after_one_more_batch(spark, scratch):
    files = FILES[:2] + [[("mid", "00:09:40", 7.0)]] + FILES[2:]
    got, log = _run(spark, scratch, files, lambda tx: windows.store_tumbling_summary(tx))
    assert got == {("00:00:00", 2, 3.0), ("00:09:00", 2, 11.0), ("00:10:00", 1, 3.0)}
    prog = stream_progress(log).first()
    assert prog.rows_dropped_by_watermark == 1
    assert prog.input_rows == 7
    assert (prog.total_records, prog.valid_records) == (7, 7)


def test_stream_counts_rejected_messages(spark, scratch):
    bad = [("x", "nope", 1.0)]
    _, log = _run(spark, scratch, [FILES[0] + bad, FILES[1]], lambda tx: windows.store_tumbling_summary(tx))
    prog = stream_progress(log).first()
    assert (prog.total_records, prog.valid_records) == (4, 3)


def test_message_without_an_id_still_counts(spark, scratch):
    """Only a message without an event time is left out of the aggregates."""
    os.makedirs(f"{scratch}/in")
    rows = [{"timestamp": "2025-01-01T00:00:05", "store_id": "s", "final_amount": 2.0},
            {"transaction_id": "a", "timestamp": "2025-01-01T00:00:06", "store_id": "s", "final_amount": 3.0},
            {"transaction_id": "b", "store_id": "s", "final_amount": 9.0}]
    with open(f"{scratch}/in/a.txt", "w") as fh:
        fh.write("\n".join(map(json.dumps, rows)) + "\n{bad\n")
    raw = spark.read.text(f"{scratch}/in")
    r = jobs.store_summary_stream(raw, watermark=None).where("window_start = '2025-01-01'").first()
    assert (r.total_transactions, float(r.total_revenue)) == (1, 5.0)


def test_progress_covers_more_batches_than_spark_keeps(spark, scratch):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        files = [[(f"t{i}", f"00:{i:02d}:30", 1.0)] for i in range(12)]
        _, log = _run(spark, scratch, files, lambda tx: windows.store_tumbling_summary(tx))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    prog = stream_progress(log).first()
    assert prog.input_rows == 12 and prog.total_records == 12 and prog.batches >= 12
    assert log.where("num_input_rows > 0").count() == 12


def test_latency_from_stored_rows(spark, scratch):
    _run(spark, scratch, FILES, lambda tx: windows.store_tumbling_summary(tx))
    stored = spark.read.parquet(f"{scratch}/tables/tumbling_summary")
    r = processing_latency(stored, "window_end", "created_at").first()
    assert r.rows == stored.count() and 0 < r.avg_latency and r.p95_latency <= r.p99_latency
    assert processing_latency(stored.limit(0), "window_end", "created_at").first().rows == 0


def test_stream_equals_batch_on_closed_windows(spark, scratch):
    from tillstream.sources import testdata
    from conftest import SF001
    msgs = testdata.event_messages(spark, SF001)
    msgs.select("value").write.text(f"{scratch}/in")
    raw = text_stream(spark, f"{scratch}/in")
    jobs.run_until_caught_up(jobs.store_summary_stream(raw), f"{scratch}/out", f"{scratch}/ck")
    streamed = spark.read.parquet(f"{scratch}/out")
    batch = windows.store_window_summary(testdata.event_transactions(spark, SF001), watermark=None)
    wm = testdata.event_transactions(spark, SF001).agg(F.max("event_time")).first()[0]
    closed = batch.where(F.col("window_end") <= F.lit(wm) - F.expr("INTERVAL 1 MINUTE"))
    streamed, closed = streamed.drop("unique_customers"), closed.drop("unique_customers")
    assert streamed.exceptAll(closed).count() == 0
    assert closed.exceptAll(streamed).count() == 0


def test_restart_from_checkpoint_adds_nothing(spark, scratch):
    _write_files(f"{scratch}/in", FILES)
    build = lambda: windows.store_tumbling_summary(
        transactions_from_messages(text_stream(spark, f"{scratch}/in", 1)))
    jobs.run_until_caught_up(build(), f"{scratch}/out", f"{scratch}/ck")
    first = sorted(spark.read.parquet(f"{scratch}/out").collect())
    jobs.run_until_caught_up(build(), f"{scratch}/out", f"{scratch}/ck")
    assert sorted(spark.read.parquet(f"{scratch}/out").collect()) == first


def test_all_retail_streams_together(spark, scratch):
    """The queries share one source folder, each with its own checkpoint;
    duplicates of a transaction id reach the raw table once."""
    files = FILES + [[("a", "00:00:05", 1.0)]]  # replay of "a" within the delay
    _write_files(f"{scratch}/in", files)
    paths = jobs.StreamPaths(scratch)
    once = {"availableNow": True}
    qs = jobs.start_retail_streams(
        spark, lambda: text_stream(spark, f"{scratch}/in"), paths,
        {k: once for k in jobs.TRIGGERS}, raw_transactions=True)
    for q in qs:
        q.awaitTermination()
        assert q.exception() is None
    summary = spark.read.parquet(paths.table("transactions_summary"))
    assert summary.where("window_date = '2025-01-01'").count() > 0
    metrics = spark.read.parquet(paths.table("realtime_metrics"))
    assert set(r.metric_name for r in metrics.collect()) == {
        "transactions_per_window", "revenue_per_window", "avg_transaction_value"}
    raw = spark.read.parquet(paths.table("transactions"))
    ids = [r.transaction_id for r in raw.collect()]
    assert sorted(ids) == sorted({"a", "b", "c", "late", "ok", "z"})


def test_run_entry_point_once(spark, scratch):
    from tillstream.streaming import run
    _write_files(f"{scratch}/in", FILES)
    qs = run.main(["--source", "files", "--input", f"{scratch}/in", "--root", f"{scratch}/out", "--once"],
                  spark=spark)
    assert len(qs) == 3 and all(q.exception() is None for q in qs)
    assert spark.read.parquet(f"{scratch}/out/tables/transactions_summary").count() > 0
    assert read_progress(spark, f"{scratch}/out/progress/transactions_summary").where("num_input_rows > 0").count() > 0


DAY = TimeRange(dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2))
COLS = ["window_start", "store_id", "total_transactions", "total_revenue"]


def test_backfill_twice_equals_once(spark, scratch):
    _write_files(f"{scratch}/in", FILES)
    paths = jobs.StreamPaths(f"{scratch}/root")
    raw = spark.read.text(f"{scratch}/in")
    jobs.backfill(spark, raw, paths, DAY)
    first = sorted(spark.read.parquet(paths.table("transactions_summary")).select(*COLS).collect())
    jobs.backfill(spark, raw, paths, DAY)
    again = sorted(spark.read.parquet(paths.table("transactions_summary")).select(*COLS).collect())
    # six messages, each in two sliding windows; those of the window that the range cuts are left
    assert again == first and len(first) == 7
    assert sum(r.total_transactions for r in first) == 2 * 6 - 2
    metrics = spark.read.parquet(paths.table("realtime_metrics"))
    assert metrics.count() == 3 * 5  # three metrics for each of five 30-second windows


def test_backfill_over_a_streamed_table(spark, scratch):
    """Reads by range and of the whole table agree before and after, and the re-loaded rows win."""
    from tillstream.sources.tables import read_summary
    _write_files(f"{scratch}/in", FILES + [[("end", "02:00:00", 1.0)]])
    paths = jobs.StreamPaths(scratch)
    jobs.catch_up(jobs.store_summary_stream(text_stream(spark, f"{scratch}/in", 1)), paths, TRANSACTIONS_SUMMARY, "q")
    table = paths.table("transactions_summary")
    before = {(r.window_start, r.store_id): r.total_transactions for r in read_summary(spark, table).collect()}
    assert len(before) == read_summary(spark, table).count()
    _write_files(f"{scratch}/more", FILES + [[("new", "00:00:20", 7.0), ("end", "02:00:00", 1.0)]])
    jobs.backfill(spark, spark.read.text(f"{scratch}/more"), paths, DAY)
    rows = read_summary(spark, table).collect()
    after = {(r.window_start, r.store_id): r.total_transactions for r in rows}
    assert len(rows) == len(after) and after[(dt.datetime(2025, 1, 1), "s")] == before[(dt.datetime(2025, 1, 1), "s")] + 1
    ranged = read_summary(spark, table, TimeRange(dt.datetime(2024, 12, 31), dt.datetime(2025, 1, 2)))
    assert sorted(ranged.select(*COLS).collect()) == sorted(spark.read.parquet(table).select(*COLS).collect())


def test_backfill_refuses_a_range_that_cuts_windows(spark, scratch):
    raw = spark.createDataFrame([], "value string")
    for rng in (TimeRange(dt.datetime(2025, 1, 1, 0, 1), DAY.end), TimeRange(DAY.start, None)):
        with pytest.raises(ValueError):
            jobs.backfill(spark, raw, jobs.StreamPaths(scratch), rng)


def test_long_store_ids_are_kept_as_rejects(spark, scratch):
    """Four messages with a 51-character store: no stored row, but four rejected windows' worth of rows."""
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/a.txt", "w") as fh:
        for i in range(4):
            fh.write(_msg(f"m{i}", f"00:00:0{i}", 1.0).replace('"store_id": "s"', '"store_id": "%s"' % ("x" * 51)) + "\n")
        fh.write(_msg("end", "01:00:00", 1.0) + "\n")
    paths = jobs.StreamPaths(scratch)
    jobs.catch_up(jobs.store_summary_stream(text_stream(spark, f"{scratch}/in")), paths, TRANSACTIONS_SUMMARY, "q")
    rejects = spark.read.parquet(paths.table("transactions_summary") + "_rejects").collect()
    assert {r.reject_reason for r in rejects} == {"store_id longer than 50"}
    assert sum(json.loads(r.row)["total_transactions"] for r in rejects) == 2 * 4


def test_a_root_is_needed():
    """Without --root and spark.checkpoint.dir a deployment ends, and scratch
    folders are made on one local process only."""
    from types import SimpleNamespace

    from tillstream.session import checkpoint_root
    from tillstream.streaming import run
    settings = {}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: settings.get(k, d)))
    with pytest.raises(SystemExit):
        run.root_of(run.parse_args(["--source", "files"]), session)
    assert run.root_of(run.parse_args(["--root", "/r"]), session) == "/r"
    for master in ("yarn", "local-cluster[3,2,1024]", "spark://h:7077"):
        settings["spark.master"] = master
        with pytest.raises(ValueError):
            checkpoint_root(session)
    settings["spark.checkpoint.dir"] = "/shared/"
    assert run.root_of(run.parse_args([]), session) == "/shared/tillstream"
    assert checkpoint_root(session) == "/shared"


def test_foreach_batch_writer_stream_and_restart(spark, scratch):
    from tillstream.schemas import TRANSACTIONS_SUMMARY
    from tillstream.sinks.parquet import IdempotentBatchWriter
    _write_files(f"{scratch}/in", FILES)
    writer = IdempotentBatchWriter(f"{scratch}/t", TRANSACTIONS_SUMMARY)

    def run():
        df = windows.store_window_summary(transactions_from_messages(text_stream(spark, f"{scratch}/in", 1)))
        q = jobs.run_with_batch_writer(df, writer, f"{scratch}/ck", {"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None

    run()
    cols = ["window_start", "store_id", "total_transactions", "total_revenue"]
    first = sorted(spark.read.parquet(f"{scratch}/t").select(*cols).collect())
    assert {(str(r.window_start)[11:19], r.total_transactions) for r in first} == {
        ("23:59:30", 2), ("00:00:00", 3), ("00:00:30", 1), ("00:09:00", 1), ("00:09:30", 2), ("00:10:00", 1)}
    run()  # restart from the checkpoint: nothing new, nothing duplicated
    assert sorted(spark.read.parquet(f"{scratch}/t").select(*cols).collect()) == first


def test_sketch_summary_runs_on_a_stream(spark, scratch):
    from tillstream.operators import rollups
    _write_files(f"{scratch}/in", FILES)
    raw = text_stream(spark, f"{scratch}/in", 1)
    df = windows.store_tumbling_summary(transactions_from_messages(raw), sketch=True)
    jobs.run_until_caught_up(df, f"{scratch}/out", f"{scratch}/ck")
    est = rollups.distinct_customers(spark.read.parquet(f"{scratch}/out")).first()
    assert est.distinct_customers == 1  # every message has customer "c"


def test_await_all_waits_for_every_query(spark, scratch):
    _write_files(f"{scratch}/in", FILES)
    once = {"availableNow": True}
    qs = [jobs.run_to_parquet(windows.store_tumbling_summary(
              transactions_from_messages(text_stream(spark, f"{scratch}/in"))),
              f"{scratch}/out{i}", f"{scratch}/ck{i}", once) for i in range(2)]
    jobs.await_all(spark, qs)
    assert not any(q.isActive for q in qs)
    assert all(spark.read.parquet(f"{scratch}/out{i}").count() == 3 for i in range(2))
