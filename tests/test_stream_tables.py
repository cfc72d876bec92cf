"""Streams into keyed tables, sessions, decoding once, repair of late rows, panes, open windows."""

import datetime as dt
import glob
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tillstream.contract import QUERIES
from tillstream.functions.timebounds import TimeRange
from tillstream.operators import sessions, windows
from tillstream.plans import plan_text
from tillstream.schemas import CUSTOMER_SESSIONS, TRANSACTIONS, TRANSACTIONS_SUMMARY
from tillstream.session import checkpoint_root
from tillstream.sources import testdata
from tillstream.sources.decode import parse_messages, transactions_from_messages
from tillstream.sources.streams import text_stream
from tillstream.sources.tables import read_summary, read_table
from tillstream.streaming import decoded, jobs, open_windows, repair

T0 = dt.datetime(2025, 1, 1)


def put(folder, *files):
    """Message files, modification times in order."""
    os.makedirs(folder, exist_ok=True)
    have = len(os.listdir(folder))
    for i, messages in enumerate(files, have):
        path = os.path.join(folder, f"part-{i:03d}.txt")
        with open(path, "w") as fh:
            fh.write("\n".join(json.dumps(m) for m in messages) + "\n")
        os.utime(path, (time.time() - 1000 + 10 * i,) * 2)


def sale(tid, at, amount=1.0, store="s", **more):
    return {"transaction_id": tid, "timestamp": at.isoformat(), "store_id": store, "customer_id": f"c{tid}",
            "total_amount": amount, "final_amount": amount, **more}


# --- panes ---

def test_panes_equal_expanded_windows(spark):
    rnd = random.Random(1)
    rows = [(None if rnd.random() < .05 else f"t{i}", None if rnd.random() < .02 else T0 + dt.timedelta(seconds=rnd.randrange(-900, 900), microseconds=rnd.choice([0, 1, 999_999])),
             rnd.choice(["a", "b", None]), rnd.choice([None, "c1", "c2", "c3"]), None if rnd.random() < .1 else rnd.randrange(1, 500) / 100)
            for i in range(1500)]
    tx = spark.createDataFrame(rows, "transaction_id string, event_time timestamp, store_id string, customer_id string, final_amount double")
    for window, slide in (("1 minute", "30 seconds"), ("5 minutes", "1 minute"), ("30 seconds", "30 seconds")):
        panes = windows.pane_window_summary(tx, window, slide)
        win = F.window("event_time", window, slide)
        direct = tx.groupBy(win.alias("w"), "store_id").agg(
            F.count("transaction_id").alias("n"), F.sum(F.col("final_amount").cast("decimal(12,2)")).cast("decimal(12,2)").alias("r"),
            F.count_distinct("customer_id").alias("u")).select("w.start", "w.end", "store_id", "n", "r", "u")
        got = panes.select("window_start", "window_end", "store_id", "total_transactions", "total_revenue", "unique_customers")
        assert sorted(str(tuple(r)) for r in got.collect()) == sorted(str(tuple(r)) for r in direct.collect())
    with pytest.raises(ValueError):
        windows.pane_window_summary(tx, "1 minute", "45 seconds")


def test_events_are_aggregated_before_windows_expand(spark):
    """The expansion into windows lies above the first aggregate, and events are shuffled once."""
    lines = plan_text(QUERIES["store_window_summary"](spark, SF001), "simple").splitlines()
    first_agg = max(i for i, ln in enumerate(lines) if "HashAggregate" in ln)  # the lowest one
    expand = [i for i, ln in enumerate(lines) if "Generate explode(filter(" in ln]
    assert len(expand) == 1 and expand[0] < first_agg
    assert sum("Exchange" in ln for ln in lines) == 2 and not any("Expand" in ln for ln in lines)


# --- K11: keys whatever the day ---

def test_a_key_is_stored_once_whatever_its_day(spark, scratch):
    paths = jobs.StreamPaths(scratch)
    late = dt.datetime(2025, 1, 1, 23, 59)
    put(f"{scratch}/in", [sale("a", late), sale("b", late)])
    for more in ([sale("a", late + dt.timedelta(minutes=2)), sale("c", late)], [sale("c", late - dt.timedelta(days=3)), sale("b", late)]):
        jobs.catch_up(jobs.raw_transactions_stream(text_stream(spark, f"{scratch}/in")), paths, TRANSACTIONS, "raw")
        put(f"{scratch}/in", more)
    jobs.catch_up(jobs.raw_transactions_stream(text_stream(spark, f"{scratch}/in")), paths, TRANSACTIONS, "raw")
    rows = read_table(spark, paths.table(TRANSACTIONS.name), TRANSACTIONS.name).collect()
    assert sorted((r.transaction_id, r.timestamp) for r in rows) == [("a", late), ("b", late), ("c", late)]


# --- late rows ---

def test_repair_mends_only_what_changed(spark, scratch):
    paths = jobs.StreamPaths(scratch)
    day = lambda d, m: T0 + dt.timedelta(days=d, minutes=m)
    files = [[sale("a", day(0, 5)), sale("b", day(1, 5)), sale("c", day(2, 5)), sale("z", day(4, 0))],
             [sale("late", day(1, 5), 7.0), sale("alone", day(1, 30)), sale("z2", day(4, 0))]]
    for messages in files:
        put(f"{scratch}/in", messages)
        source = lambda: text_stream(spark, f"{scratch}/in")
        jobs.catch_up(jobs.store_summary_stream(source()), paths, TRANSACTIONS_SUMMARY, "summary")
        jobs.catch_up(jobs.raw_transactions_stream(source()), paths, TRANSACTIONS, "raw")
    summary, raw = paths.table(TRANSACTIONS_SUMMARY.name), paths.table(TRANSACTIONS.name)
    counts = lambda: {(r.window_start, r.total_transactions, float(r.total_revenue), r.unique_customers)
                      for r in read_summary(spark, summary).collect()}
    assert (day(1, 5), 1, 1.0, 1) in counts()  # the late row was dropped
    files_of = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{summary}/window_date=*/*/*.parquet")}
    before = files_of()
    assert repair.repair_late_rows(spark, raw, summary, day(4, 0)) == 4
    batch = windows.store_window_summary(transactions_from_messages(spark.read.text(f"{scratch}/in")), watermark=None)
    want = {(r.window_start, r.total_transactions, float(r.total_revenue), r.unique_customers)
            for r in batch.where(F.col("window_end") <= F.lit(day(4, 0))).collect()}
    assert counts() == want and (day(1, 5), 2, 8.0, 2) in want
    after = files_of()
    assert all(before[f] == after[f] for f in before if "window_date=2025-01-02" not in f)
    assert repair.repair_late_rows(spark, raw, summary, day(4, 0)) == 0 and files_of() == after


# --- decode once ---

def test_one_parse_per_message_and_unknown_fields_survive(spark, scratch):
    put(f"{scratch}/in", [sale("a", T0, 2.5, coupon={"code": "X", "off": [1, 2]}, items=[{"product_id": "p", "quantity": 2, "total": 2.5}]),
                          sale("b", T0 + dt.timedelta(minutes=1), coupon={"code": "Y"}), {"transaction_id": 5}])
    with open(f"{scratch}/in/part-009.txt", "w") as fh:
        fh.write("{bad\n\n[1]\n")
    raw = spark.read.text(f"{scratch}/in")
    table = decoded.decoded_messages(raw)
    plan = plan_text(table, "simple")
    assert plan.count("parseJson(") == 1 and "from_json" not in plan and "get_json_object" not in plan
    jobs.run_to_parquet(decoded.decode_stream(text_stream(spark, f"{scratch}/in")), f"{scratch}/d", f"{scratch}/c").awaitTermination()
    stored = spark.read.parquet(f"{scratch}/d")
    assert sorted(r.field for r in decoded.message_field(stored, "$.coupon.code", "string").collect()) == ["X", "Y"]
    assert stored.count() == raw.count() and stored.where("is_valid").count() == 2
    typed = parse_messages(raw, "transactions")
    same = ["transaction_id", "timestamp", "store_id", "customer_id", "items", "total_amount", "final_amount", "event_time"]
    rows = lambda df: sorted(map(str, df.where("event_time is not null").select(*same).collect()))
    assert rows(stored) == rows(typed)


def test_streams_on_decoded_messages_give_the_same_tables(spark, scratch):
    """All three outputs equal those of streams that parse for themselves."""
    messages = testdata.event_messages(spark, SF001, items=True, rng=TimeRange(None, dt.datetime(2024, 1, 6)))
    messages.select("value").repartition(2).write.text(f"{scratch}/in")
    every = {name: {"processingTime": "1 second"} for name in (*jobs.TRIGGERS, "decoded")}
    one, own = jobs.StreamPaths(f"{scratch}/one"), jobs.StreamPaths(f"{scratch}/own")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        source = lambda: text_stream(spark, f"{scratch}/in")
        jobs.drain(jobs.start_retail_streams(spark, source, own, every))
        jobs.run_to_parquet(decoded.decode_stream(source()), one.table("decoded"), one.checkpoint("decoded")).awaitTermination()
        jobs.drain(jobs.start_from_decoded(spark, one, every))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for name in ("transactions_summary", "product_performance", "realtime_metrics"):
        tables = [read_table(spark, p.table(name), name).drop("created_at") for p in (one, own)]
        assert sorted(map(str, tables[0].collect())) == sorted(map(str, tables[1].collect())) != []
    plan = jobs.windows.realtime_window_metrics(decoded.decoded_source(spark, one.table("decoded")))
    assert "json" not in plan._jdf.queryExecution().analyzed().toString().lower()


# --- sessions ---

def brute_sessions(events, gap):
    out = []
    by = {}
    for e in events:
        if e[0] is not None and e[1] is not None:
            by.setdefault(e[0], []).append(e)
    for customer, mine in by.items():
        mine.sort(key=lambda e: (e[1], e[2]))
        start = 0
        for i in range(1, len(mine) + 1):
            if i == len(mine) or mine[i][1] - mine[i - 1][1] > gap:
                part = mine[start:i]
                out.append((customer, part[0][1], part[-1][1], len(part), sum(e[3] for e in part), part[0][4], part[-1][5]))
                start = i
    return sorted(out)


def session_rows(df):
    return sorted((r.customer_id, r.session_start, r.session_end, r.events, r.page_views, r.first_store, r.last_event_type) for r in df.collect())


def test_sessions_against_gaps(spark, scratch):
    rnd = random.Random(3)
    events = [(rnd.choice(["a", "b", None]), T0 + dt.timedelta(seconds=rnd.randrange(0, 40_000) // 10 * 10), f"e{i:04d}",
               rnd.randrange(5), f"s{rnd.randrange(3)}", rnd.choice(["view", "buy"])) for i in range(200)]
    events += [("c", T0, "x1", 1, "s", "view"), ("c", T0 + dt.timedelta(minutes=2), "x2", 1, "s", "buy"),
               ("c", T0 + dt.timedelta(minutes=4, microseconds=1), "x3", 1, "s", "view")]  # one gap exactly, then just over
    df = spark.createDataFrame([(c, t, e, v, s, k) for c, t, e, v, s, k in events],
                               "customer_id string, event_time timestamp, event_id string, page_views int, store_id string, event_type string")
    assert session_rows(sessions.customer_sessions(df, "2 minutes")) == brute_sessions(events, dt.timedelta(minutes=2))
    # as a stream: out of order within the watermark, the last event closes all before it
    rnd.shuffle(events)
    message = lambda e: {"event_id": e[2], "timestamp": e[1].isoformat(), "customer_id": e[0], "event_type": e[5],
                         "store_id": e[4], "page_views": e[3]}
    told = [e for e in events if e[0]]
    put(f"{scratch}/in", *[[message(e) for e in told[i::3]] for i in range(3)],
        [message(("end", T0 + dt.timedelta(days=9), "z", 0, "s", "view"))])
    paths = jobs.StreamPaths(scratch)
    raw = text_stream(spark, f"{scratch}/in", max_files_per_trigger=1)
    jobs.catch_up(jobs.session_stream(raw, "2 minutes", "1 day"), paths, CUSTOMER_SESSIONS, "sessions")
    stored = read_table(spark, paths.table(CUSTOMER_SESSIONS.name), CUSTOMER_SESSIONS.name)
    assert session_rows(stored) == brute_sessions(told, dt.timedelta(minutes=2))


# --- stock, open windows ---

def test_stock_stream_replaces_a_keys_row_and_restarts(spark, scratch):
    paths = jobs.StreamPaths(scratch)
    stock = lambda e, minute, n, p="p1": {"event_id": e, "timestamp": (T0 + dt.timedelta(minutes=minute)).isoformat(),
                                          "store_id": "s1", "product_id": p, "current_stock": n, "reorder_level": 5}
    steps = [([stock("a", 10, 50), stock("b", 5, 3, "p2")], {("p1", 50, False), ("p2", 3, True)}),
             ([stock("c", 8, 1), stock("d", 20, 9, "p2")], {("p1", 50, False), ("p2", 9, False)}),  # older news changes nothing
             ([stock("d", 20, 9, "p2"), {"event_id": "x"}, stock("e", 30, 4)], {("p1", 4, True), ("p2", 9, False)})]
    for messages, want in steps:
        put(f"{scratch}/in", messages)
        query = jobs.run_stock(text_stream(spark, f"{scratch}/in"), paths, {"availableNow": True}, buckets=4)
        query.awaitTermination()
        assert query.exception() is None
        rows = jobs.stock_table(spark, paths, 4).read().collect()
        assert {(r.product_id, r.current_stock, r.reorder) for r in rows} == want and len(rows) == 2


def test_open_windows_complete_the_table(spark, scratch):
    paths = jobs.StreamPaths(scratch)
    put(f"{scratch}/in", [sale("a", T0, 2.0), sale("b", T0 + dt.timedelta(seconds=40), 3.0)], [sale("c", T0 + dt.timedelta(minutes=10), 4.0)])
    jobs.catch_up(jobs.store_summary_stream(text_stream(spark, f"{scratch}/in")), paths, TRANSACTIONS_SUMMARY, "summary")
    stored = read_summary(spark, paths.table(TRANSACTIONS_SUMMARY.name))
    both = open_windows.with_open_windows(stored, open_windows.open_store_windows(spark, paths.checkpoint(TRANSACTIONS_SUMMARY.name)))
    rows = {(r.window_start - T0, r.total_transactions, float(r.total_revenue), r.closed) for r in both.collect()}
    s = lambda n: dt.timedelta(seconds=n)
    assert rows == {(s(-30), 1, 2.0, True), (s(0), 2, 5.0, True), (s(30), 1, 3.0, True), (s(570), 1, 4.0, False), (s(600), 1, 4.0, False)}


def test_entry_point_with_all_topics(spark, scratch):
    from tillstream.streaming import run
    items = [{"product_id": "p", "product_name": "n", "category": "c", "quantity": 2, "total": 2.0}]
    put(f"{scratch}/sales", [sale("a", T0, 2.0, items=items)], [sale("z", T0 + dt.timedelta(hours=1), items=items)])
    put(f"{scratch}/people", [{"event_id": e, "timestamp": (T0 + dt.timedelta(minutes=m)).isoformat(), "customer_id": "c", "page_views": 1}
                              for e, m in (("1", 0), ("2", 5), ("3", 600))])
    put(f"{scratch}/stock", [{"event_id": "1", "timestamp": T0.isoformat(), "store_id": "s", "product_id": "p", "current_stock": 1, "reorder_level": 2}])
    base = ["--source", "files", "--input", f"{scratch}/sales", "--root", f"{scratch}/out", "--once"]
    queries = run.main([*base, "--decode-once", "--customer-events", f"{scratch}/people", "--inventory", f"{scratch}/stock"], spark)
    assert len(queries) == 6 and not any(q.isActive for q in queries)
    paths = jobs.StreamPaths(f"{scratch}/out")
    assert read_summary(spark, paths.table(TRANSACTIONS_SUMMARY.name)).count() == 2
    assert read_table(spark, paths.table("product_performance"), "product_performance").first().quantity_sold == 2
    [session] = read_table(spark, paths.table(CUSTOMER_SESSIONS.name), CUSTOMER_SESSIONS.name).collect()
    assert (session.events, session.duration_us) == (2, 300_000_000)
    assert [r.reorder for r in jobs.stock_table(spark, paths).read().collect()] == [True]
    for wrong in ([*base, "--inventory"], [*base, "--decode-once", "--raw-transactions"]):
        with pytest.raises(SystemExit):
            run.main(wrong, spark)


# --- input of any size ---

def star_tables(spark, folder, orders=300):
    """Orders of unordered times with up to four lines each, a few without a time or a part."""
    rnd = random.Random(5)
    day = lambda k: dt.datetime(2024, 1, 1) + dt.timedelta(days=k)
    dates = [None if k % 97 == 0 else day(rnd.randrange(120)) for k in range(orders)]
    lines = [(k, rnd.randrange(45), rnd.randrange(60), n, float(rnd.randrange(1, 9)), round(rnd.uniform(1, 99), 2), day(rnd.randrange(120)))
             for k in range(orders) for n in range(1, rnd.randrange(2, 6))]
    tables = {"orders": ([(k, k, d) for k, d in enumerate(dates)], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"),
              "part": ([(k, f"name {k}", f"type {k % 7}") for k in range(40)], "p_partkey bigint, p_name string, p_type string"),
              "lineitem": (lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                                  "l_extendedprice double, l_shipdate timestamp_ntz")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return len(lines)


def files_and_batches(root, name):
    import os
    parts = [f for f in os.listdir(f"{root}/in") if f.startswith("part-")]
    return len(parts), len([f for f in os.listdir(f"{root}/checkpoints/{name}/commits") if f.isdigit()])


def test_stock_messages_are_dealt_to_files_of_bounded_size(spark, scratch, monkeypatch):
    from tillstream.contract import queries as Q
    lines = star_tables(spark, f"{scratch}/sf")
    monkeypatch.setattr(Q, "FILE_LINES", 20, raising=False)
    monkeypatch.setattr(Q, "_paths", lambda spark, name: jobs.StreamPaths(f"{scratch}/{name}"))
    streamed = sorted(Q.q_stream_stock_levels(spark, f"{scratch}/sf").collect())
    files, batches = files_and_batches(f"{scratch}/stock_levels", "stock_levels")
    assert files >= lines / 20 and batches == 3
    assert streamed == sorted(Q.q_stock_levels(spark, f"{scratch}/sf").collect()) and streamed


def shuffle_files(spark):
    return {f for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
            for f in glob.glob(f"{d}/*/shuffle_*.data")}


def test_stock_stream_leaves_no_more_on_disk_than_it_needs(spark, scratch, monkeypatch):
    from tillstream.contract import queries as Q
    lines = star_tables(spark, f"{scratch}/sf")
    monkeypatch.setattr(Q, "_paths", lambda spark, name: jobs.StreamPaths(f"{scratch}/{name}"))
    staged = f"{checkpoint_root(spark)}/staging/stock_levels/*"
    old_staged, old_shuffles = set(glob.glob(staged)), shuffle_files(spark)
    streamed = Q.q_stream_stock_levels(spark, f"{scratch}/sf")
    until = time.time() + 20
    while (left := shuffle_files(spark) - old_shuffles) and time.time() < until:  # they are removed in the background
        time.sleep(0.2)
    assert not left and set(glob.glob(staged)) <= old_staged
    assert not [f for f in glob.glob(f"{scratch}/stock_levels/in/part-*") if not f.endswith(".gz")]
    parts = [f.split("/")[-1] for f in glob.glob(f"{scratch}/stock_levels/tables/stock_levels/data/*/part=*")]
    assert sorted(parts) == sorted(set(parts)) and len(parts) == 8  # one version of each bucket
    assert len(glob.glob(f"{scratch}/stock_levels/tables/stock_levels/commits/0*")) == 1
    messages = spark.read.text(f"{scratch}/stock_levels/in")
    assert messages.count() == lines + spark.read.parquet(f"{scratch}/sf/lineitem.parquet").where("l_orderkey % 10 = 0").count() > lines
    assert sorted(streamed.collect()) == sorted(Q.q_stock_levels(spark, f"{scratch}/sf").collect())


def test_what_is_dealt_are_the_lines_not_their_messages(spark, scratch):
    star_tables(spark, f"{scratch}/sf")
    again = F.col("l_orderkey") % 10 == 0
    dealt = testdata.inventory_messages(spark, f"{scratch}/sf", again=again, unordered=5).select("value")
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructsToJson") == 1 and plan.index("StructsToJson") < plan.index("Repartition") and "l_extendedprice" not in plan.split("Relation")[0]
    once = testdata.inventory_messages(spark, f"{scratch}/sf")
    twice = once.unionByName(once.where(F.col("key").cast("bigint") % 10 == 0)).select("value")
    assert sorted(dealt.collect()) == sorted(twice.collect()) and dealt.rdd.getNumPartitions() == 5


def test_stock_stream_keeps_as_many_versions_as_asked_for(spark, scratch):
    for keep, commits in ((None, 3), (2, 2)):
        paths = jobs.StreamPaths(f"{scratch}/{keep}")
        for n in range(3):
            put(f"{paths.root}/in", [{"event_id": str(n), "timestamp": (T0 + dt.timedelta(minutes=n)).isoformat(),
                                      "store_id": "s", "product_id": "p", "current_stock": n, "reorder_level": 5}])
            jobs.run_stock(text_stream(spark, f"{paths.root}/in"), paths, {"availableNow": True}, buckets=4, keep=keep).awaitTermination()
        assert [r.current_stock for r in jobs.stock_table(spark, paths, 4).read().collect()] == [2]
        assert len(glob.glob(f"{paths.root}/tables/stock_levels/commits/0*")) == commits
        assert len(glob.glob(f"{paths.root}/tables/stock_levels/data/*/part=*")) == commits


def test_product_messages_arrive_in_order_in_bounded_batches(spark, scratch, monkeypatch):
    from tillstream.contract import queries as Q
    lines = star_tables(spark, f"{scratch}/sf")
    monkeypatch.setattr(Q, "FILE_LINES", 10, raising=False)
    monkeypatch.setattr(Q, "BATCH_LINES", 400, raising=False)
    monkeypatch.setattr(Q, "_paths", lambda spark, name: jobs.StreamPaths(f"{scratch}/{name}"))
    streamed = sorted(Q.q_stream_product_performance(spark, f"{scratch}/sf").collect())
    _, batches = files_and_batches(f"{scratch}/product_window_performance", "product_performance")
    assert batches >= lines / 400 > 1
    # No message is late: all windows of the batch result but those that the watermark has not passed.
    table = Q.q_product_window_performance(spark, f"{scratch}/sf").where("window_start IS NOT NULL").collect()
    latest = max(r.window_start for r in table)
    assert streamed == sorted(r for r in table if r.window_start < latest) and streamed
    assert "HDFSBacked" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")  # other streams keep theirs


def test_files_are_dated_in_the_order_of_their_names(spark, scratch):
    import os
    from tillstream.sources.streams import date_in_order
    spark.range(40).selectExpr("CAST(id AS string) AS value").repartition(5).write.text(f"{scratch}/in")
    parts = sorted(f for f in os.listdir(f"{scratch}/in") if f.startswith("part-"))
    for k, name in enumerate(parts):
        os.utime(f"{scratch}/in/{name}", (1e9 - k, 1e9 - k))
    date_in_order(spark, f"{scratch}/in")
    dates = [os.path.getmtime(f"{scratch}/in/{name}") for name in parts]
    assert len(parts) == 5 and dates == sorted(set(dates))
