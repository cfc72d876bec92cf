"""Contract queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each one reads the test tables through ``sources.testdata`` (trailing ranges
become scan predicates), runs the library operator, and hands back plain
output types: decimals are computed exactly and rounded once, then shown as
DOUBLE; times are zoneless (TIMESTAMP_NTZ).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, TimestampType

from tillstream.contract import params as P
from tillstream.functions.timebounds import TimeRange, in_range, trailing
from tillstream.operators import hierarchy, insight, keyed, latest, rollups, sessions, trailing as polls, windows
from tillstream.schemas import (CUSTOMER_SESSIONS, PRODUCT_PERFORMANCE, REALTIME_METRICS, SPARSE_PRODUCTS, TRANSACTIONS,
                                TRANSACTIONS_SUMMARY, TUMBLING_SUMMARY)
from tillstream.session import (BOUNDED_STATE, DENSE_FILES, SHUFFLES_DROPPED, configure, default_parallelism,
                                scratch_path, temporary_conf)
from tillstream.sinks.contracts import REJECT_REASON, conform
from tillstream.sinks.export import export_csv, export_json
from tillstream.sinks.metrics import metrics_long
from tillstream.sinks.parquet import IdempotentBatchWriter, merge_into_table, write_table
from tillstream.sources import testdata
from tillstream.sources.decode import parse_messages
from tillstream.sources.streams import date_in_order, text_stream
from tillstream.sources.tables import read_products, read_summary, read_table
from tillstream.sinks.versioned import VersionedTable
from tillstream.streaming import decoded, jobs, open_windows, progress, repair

Query = Callable[[SparkSession, str], DataFrame]

Q1_LENGTH = dt.timedelta(minutes=1)
Q2_LENGTH = dt.timedelta(minutes=5)


def plain(df: DataFrame) -> DataFrame:
    """Output edge: DECIMAL -> DOUBLE, TIMESTAMP -> TIMESTAMP_NTZ."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# --- shared building blocks -------------------------------------------------

def event_summary(spark: SparkSession, sf: str, rng: TimeRange | None = None,
                  store: str | None = None) -> DataFrame:
    """Q1 rows whose ``window_start`` lies in ``rng``.

    A window starting in ``[a, b)`` only holds events in ``[a, b + length)``,
    so that event range goes to the scan; the window filter is then exact.
    """
    scan_rng = None if rng is None else rng.widen(after=Q1_LENGTH)
    tx = testdata.event_transactions(spark, sf, scan_rng)
    if store is not None:
        tx = tx.where(F.col("store_id") == F.lit(store))
    summary = windows.store_window_summary(tx, watermark=None)
    return summary if rng is None else summary.where(in_range("window_start", rng))


def star_products(spark: SparkSession, sf: str, rng: TimeRange | None = None) -> DataFrame:
    """Q2 rows whose ``window_start`` lies in ``rng`` (same pruning as above)."""
    scan_rng = None if rng is None else rng.widen(after=Q2_LENGTH)
    items = testdata.star_item_rows(spark, sf, scan_rng, with_product=False)
    perf = windows.product_window_performance(items, watermark=None,
                                              products=testdata.products(spark, sf))
    perf = testdata.product_key_as_id(perf)
    return perf if rng is None else perf.where(in_range("window_start", rng))


def _hour(as_of=P.EVENTS_AS_OF, span="1h") -> TimeRange:
    return trailing(as_of, span, until=as_of)


def _tumbling(spark: SparkSession, sf: str, rng: TimeRange) -> DataFrame:
    tx = testdata.event_transactions(spark, sf, rng)
    return windows.store_tumbling_summary(tx, watermark=None)


# --- the queries --------------------------------------------------------------

def q_store_window_summary(spark, sf):
    return plain(event_summary(spark, sf))


def q_store_window_summary_exact(spark, sf):
    """Q1 on a table with the exact distinct customer count (G6; streams
    need the mergeable approximate one)."""
    tx = testdata.event_transactions(spark, sf)
    return plain(windows.store_window_summary(tx, watermark=None, distinct="exact"))


def q_store_tumbling_summary(spark, sf):
    tx = testdata.event_transactions(spark, sf)
    return plain(windows.store_tumbling_summary(tx, watermark=None))


def q_product_window_performance(spark, sf):
    return plain(star_products(spark, sf))


def q_realtime_window_metrics(spark, sf):
    tx = testdata.event_transactions(spark, sf)
    return plain(windows.flatten_window(windows.realtime_window_metrics(tx, watermark=None)))


def q_summary_last_hour(spark, sf):
    rng = _hour()
    return plain(rollups.summary_totals(event_summary(spark, sf, rng)))


def q_summary_empty_range(spark, sf):
    rng = _hour(P.EMPTY_AS_OF)
    return plain(rollups.summary_totals(event_summary(spark, sf, rng)))


def q_top_stores(spark, sf):
    rng = _hour()
    return plain(rollups.top_stores(event_summary(spark, sf, rng), rng))


def q_top_products(spark, sf):
    rng = _hour(P.STAR_AS_OF)
    return plain(rollups.top_products(star_products(spark, sf, rng), rng))


def q_recent_activity(spark, sf):
    rng = _hour(span="5m")
    return rollups.recent_activity(event_summary(spark, sf, rng), rng)


def q_data_flow_stopped(spark, sf):
    """F4 where nothing has arrived."""
    rng = _hour(P.EMPTY_AS_OF, span="5m")
    return rollups.data_flow(event_summary(spark, sf, rng), rng)


def q_data_flow(spark, sf):
    rng = _hour(span="5m")
    return rollups.data_flow(event_summary(spark, sf, rng), rng)


def q_stream_stats(spark, sf):
    rng = _hour()
    return plain(rollups.stream_stats(event_summary(spark, sf, rng), rng))


def q_export_transactions(spark, sf):
    rng = _hour(span="24h")
    return plain(rollups.export_transactions(event_summary(spark, sf, rng), rng))


def q_export_products(spark, sf):
    rng = _hour(P.STAR_AS_OF, "24h")
    return plain(rollups.export_products(star_products(spark, sf, rng), rng))


def q_total_metrics(spark, sf):
    return plain(rollups.total_metrics(event_summary(spark, sf)))


def q_recent_windows(spark, sf):
    return plain(rollups.recent_windows(event_summary(spark, sf)))


def q_system_stats(spark, sf):
    return plain(rollups.system_stats(event_summary(spark, sf)))


def q_summary_row_count(spark, sf):
    return rollups.summary_row_count(event_summary(spark, sf))


def _cards(spark, sf):
    rng = _hour()
    return plain(rollups.dashboard_cards(event_summary(spark, sf, rng), rng))


def q_transactions_per_minute(spark, sf):
    return _cards(spark, sf).select("transactions_per_minute")


def q_revenue_per_hour(spark, sf):
    return _cards(spark, sf).select("revenue_per_hour")


def q_active_customers(spark, sf):
    return _cards(spark, sf).select("active_customers")


def q_events_per_second(spark, sf):
    return _cards(spark, sf).select("events_per_second")


def q_percent_change(spark, sf):
    return plain(rollups.hourly_change(event_summary(spark, sf)))


def q_active_categories(spark, sf):
    rng = _hour(P.STAR_AS_OF)
    return rollups.active_categories(star_products(spark, sf, rng), rng)


def q_revenue_by_store(spark, sf):
    rng = _hour()
    return plain(rollups.revenue_by_store(event_summary(spark, sf, rng), rng))


def q_transaction_velocity(spark, sf):
    start = P.EVENTS_AS_OF - dt.timedelta(minutes=P.VELOCITY_MINUTES)
    tx = testdata.event_transactions(spark, sf, TimeRange(start, P.EVENTS_AS_OF))
    return plain(insight.transaction_velocity(tx, P.EVENTS_AS_OF, P.VELOCITY_MINUTES))


def q_activity_heatmap(spark, sf):
    return plain(insight.activity_heatmap(testdata.event_transactions(spark, sf)))


def q_data_quality(spark, sf):
    parsed = parse_messages(testdata.event_messages(spark, sf, bad=True), "transactions")
    return plain(insight.data_quality(parsed))


def q_summary_exact(spark, sf):
    rng = _hour()
    return plain(insight.summary_exact(testdata.event_transactions(spark, sf, rng)))


def _within_tolerance(estimates: DataFrame, tx: DataFrame, rng: TimeRange) -> DataFrame:
    """Exact distinct customers per store of ``rng`` and whether the estimate lies within 5 %."""
    exact = (tx.where(in_range("event_time", rng)).groupBy("store_id")
             .agg(F.count_distinct("customer_id").alias("exact_customers")))
    within = F.abs(F.col("distinct_customers") - F.col("exact_customers")) <= F.col("exact_customers") * 0.05
    return (exact.join(estimates, "store_id", "left")
            .select("store_id", "exact_customers", F.coalesce(within, F.lit(False)).alias("within_tolerance")))


def q_sketch_customers_last_hour(spark, sf):
    """Distinct customers per store over the trailing hour from per-minute
    sketches (an estimate; the sum of per-window counts overstates)."""
    rng = _hour()
    tx = testdata.event_transactions(spark, sf, rng)
    sketched = windows.store_tumbling_summary(tx, watermark=None, sketch=True)
    return _within_tolerance(rollups.distinct_customers(sketched, rng), tx, rng)


def q_range_store_filter(spark, sf):
    rng = _hour(span=P.RANGE_FILTER_SPAN)
    summary = event_summary(spark, sf, rng, store=P.RANGE_FILTER_STORE)
    return plain(rollups.summary_totals(summary, rng, store=P.RANGE_FILTER_STORE))


def q_metrics_long(spark, sf):
    tx = testdata.event_transactions(spark, sf)
    metrics = windows.realtime_window_metrics(tx, watermark=None)
    return plain(metrics_long(metrics))


def q_raw_transactions(spark, sf):
    tx = testdata.star_transactions(spark, sf).withColumnRenamed("event_time", "timestamp")
    good, _ = conform(tx, TRANSACTIONS, stamp=False)
    return plain(good)


def _merge_sides(spark, sf):
    existing = _tumbling(spark, sf, TimeRange(None, P.MERGE_EXISTING_END))
    batch = _tumbling(spark, sf, TimeRange(P.MERGE_BATCH_START, None))
    return existing, batch


def q_insert_if_absent(spark, sf):
    existing, batch = _merge_sides(spark, sf)
    return plain(keyed.table_after_insert(existing, batch, TRANSACTIONS_SUMMARY.key))


def q_upsert_summary(spark, sf):
    existing, batch = _merge_sides(spark, sf)
    return plain(keyed.upsert(existing, batch, TRANSACTIONS_SUMMARY.key))


def q_merged_summary_table(spark, sf):
    """K7 on files: the stored table holds the earlier windows, the batch is
    merged in (batch wins), only the batch's days are rewritten."""
    existing, batch = _merge_sides(spark, sf)
    path = scratch_path(spark, "tables", "tumbling_summary")
    write_table(existing, path, TUMBLING_SUMMARY)
    merge_into_table(batch, path, TUMBLING_SUMMARY, scratch_path(spark, "staging", "tumbling_summary"))
    cols = [c.name for c in TUMBLING_SUMMARY.columns if c.name not in ("created_at", "customer_sketch")]
    return plain(spark.read.parquet(path).select(*cols))


def q_approx_within_tolerance(spark, sf):
    check = insight.approx_distinct_check(testdata.event_transactions(spark, sf))
    return check.select("store_id", "exact_customers", "within_tolerance")


# --- stored tables (K1/K2 batch write, S6/S7 pruned scans) -------------------

def q_stored_summary_last_hour(spark, sf):
    """Q4 read back from the date-partitioned ``transactions_summary`` table."""
    path = scratch_path(spark, "tables", TRANSACTIONS_SUMMARY.name)
    write_table(event_summary(spark, sf), path, TRANSACTIONS_SUMMARY)
    rng = _hour()
    return plain(rollups.summary_totals(read_summary(spark, path, rng), rng))


def q_stored_top_products(spark, sf):
    """Q6 read back from the month-partitioned ``product_performance`` table
    (the star's orders are spread thinly over years)."""
    path = scratch_path(spark, "tables", SPARSE_PRODUCTS.name)
    write_table(star_products(spark, sf), path, SPARSE_PRODUCTS)
    rng = _hour(P.STAR_AS_OF)
    return plain(rollups.top_products(read_products(spark, path, rng, SPARSE_PRODUCTS.partition_unit), rng))


def q_stored_sketch_customers(spark, sf):
    """The same from the stored per-minute sketches of the whole events table
    (no raw-event rescan for the estimate)."""
    path = scratch_path(spark, "tables", TUMBLING_SUMMARY.name)
    tx = testdata.event_transactions(spark, sf)
    write_table(windows.store_tumbling_summary(tx, watermark=None, sketch=True), path, TUMBLING_SUMMARY)
    rng = _hour()
    stored = read_table(spark, path, TUMBLING_SUMMARY.name, rng)
    return _within_tolerance(rollups.distinct_customers(stored, rng), tx, rng)


# --- exports (K8, K9) read back -------------------------------------------------

def q_exported_csv(spark, sf):
    """K8: the 24-hour CSV export, read back (times are text)."""
    rng, path = _hour(span="24h"), scratch_path(spark, "exports", "csv")
    rows = rollups.export_transactions(_stamped(event_summary(spark, sf, rng)), rng)
    export_csv(rows, path)
    times = ("window_start", "window_end", "created_at")
    ddl = ", ".join(f"{f.name} {'string' if f.name in times else _plain_type(f)}" for f in rows.schema)
    read = spark.read.schema(ddl).option("header", True).csv(path)
    return read.withColumn("created_at", F.col("created_at").isNotNull())


def _stamped(rows: DataFrame) -> DataFrame:
    """Rows as the table holds them, with the time of writing."""
    return rows.withColumn("created_at", F.current_timestamp())


def _plain_type(field) -> str:
    return "double" if isinstance(field.dataType, DecimalType) else field.dataType.simpleString()


def _exported_json(spark, sf) -> str:
    path = scratch_path(spark, "exports", "json")
    day, star = _hour(span="24h"), _hour(P.STAR_AS_OF, "24h")
    export_json(rollups.export_transactions(_stamped(event_summary(spark, sf, day)), day),
                rollups.export_products(_stamped(star_products(spark, sf, star)), star), path)
    return path


def q_exported_json(spark, sf):
    """K9: the product rows of the 24-hour JSON export, read back."""
    return spark.read.schema("window_start string, product_id string, product_name string, category string, "
                             "quantity_sold bigint, revenue double, created_at string").json(
                                 f"{_exported_json(spark, sf)}/product_performance").withColumn(
                                     "created_at", F.col("created_at").isNotNull())


def q_export_manifest(spark, sf):
    """K9: the record counts in the JSON export's manifest, read back."""
    return spark.read.schema("transactions_summary bigint, product_performance bigint, total_records bigint").json(
        f"{_exported_json(spark, sf)}/manifest")


# --- streams (file source standing in for the topic) through the stored tables --

def _paths(spark: SparkSession, name: str) -> jobs.StreamPaths:
    return jobs.StreamPaths(scratch_path(spark, "streams", name))


def _in_slices(spark, paths: jobs.StreamPaths, messages, build, contract, name) -> None:
    """The messages arrive in time slices, in order, each in several files; the
    query restarts from its checkpoint after each slice (state is carried over)."""
    edges = [None, *P.STREAM_SLICE_BOUNDS, None]
    for lo, hi in zip(edges, edges[1:]):
        messages(TimeRange(lo, hi)).select("value").write.mode("append").text(f"{paths.root}/in")
        jobs.catch_up(build(text_stream(spark, f"{paths.root}/in")), paths, contract, name,
                      state_partitions=default_parallelism(spark))


def _streamed_summary(spark, sf) -> jobs.StreamPaths:
    """Q1 as an incremental stream over messages of which some are bad."""
    paths = _paths(spark, "store_window_summary")
    _in_slices(spark, paths, lambda rng: testdata.event_messages(spark, sf, rng, bad=True),
               jobs.store_summary_stream, TRANSACTIONS_SUMMARY, "store_window_summary")
    return paths


def q_stream_store_summary(spark, sf):
    """K1: the closed windows (end <= max event time - watermark) of the
    incremental stream, as in the batch result; distinct customers are
    approximate on a stream and compared with the exact count."""
    paths = _streamed_summary(spark, sf)
    streamed = read_summary(spark, paths.table(TRANSACTIONS_SUMMARY.name))
    good = testdata.event_transactions(spark, sf).where(
        (F.col("transaction_id").cast("bigint") % 97 != 0) & (F.col("transaction_id").cast("bigint") % 89 != 0))
    exact = windows.store_window_summary(good, watermark=None).select(
        "window_start", "store_id", F.col("unique_customers").alias("exact_customers"))
    near = F.abs(F.col("unique_customers") - F.col("exact_customers")) <= F.greatest(
        F.lit(1.0), F.col("exact_customers") * 0.15)
    return plain(streamed.join(exact, ["window_start", "store_id"], "left").select(
        "window_start", "window_end", "store_id", "total_transactions", "total_revenue",
        "avg_transaction_value", F.coalesce(near, F.lit(False)).alias("unique_within_tolerance")))


def q_stream_rejected_rows(spark, sf):
    """K5 on a stream: rows that break the table contract, by reason, from the
    reject table (windows of messages without a store)."""
    path = _streamed_summary(spark, sf).table(TRANSACTIONS_SUMMARY.name)
    return (spark.read.parquet(f"{path}_rejects").groupBy(REJECT_REASON)
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.sum(F.get_json_object("row", "$.total_transactions").cast("bigint")).alias("transactions")))


#: Line items in a file of messages, and in a micro-batch of the product stream.
FILE_LINES, BATCH_LINES = 500_000, 6_000_000


def _lines(spark, sf) -> int:
    return testdata.table(spark, sf, "lineitem").count()  # of the Parquet footers


def q_stream_product_performance(spark, sf):
    """K2: orders with all their items, through the stored product table. The messages arrive in
    order of time, a bounded number a micro-batch, so that the state holds no more than one batch's windows."""
    paths = _paths(spark, "product_window_performance")
    lines = _lines(spark, sf)
    files = max(default_parallelism(spark), -(-lines // FILE_LINES))
    batches = max(1, -(-lines // BATCH_LINES))
    testdata.item_messages(spark, sf, in_order=files).select("value").write.text(f"{paths.root}/in")
    date_in_order(spark, f"{paths.root}/in")
    raw = text_stream(spark, f"{paths.root}/in", max_files_per_trigger=-(-files // batches))
    with temporary_conf(spark, BOUNDED_STATE):
        jobs.catch_up(jobs.product_stream(raw), paths, SPARSE_PRODUCTS, "product_window_performance",
                      state_partitions=default_parallelism(spark))
    cols = [c.name for c in PRODUCT_PERFORMANCE.columns if c.name != "created_at"]
    return plain(read_products(spark, paths.table(PRODUCT_PERFORMANCE.name)).select(*cols))


def q_stream_realtime_metrics(spark, sf):
    """Long-form window metrics of an incremental stream, from their table."""
    paths = _paths(spark, "realtime_window_metrics")
    _in_slices(spark, paths, lambda rng: testdata.event_messages(spark, sf, rng),
               lambda raw: metrics_long(jobs.metrics_stream(raw)), REALTIME_METRICS, "realtime_window_metrics")
    return plain(read_table(spark, paths.table(REALTIME_METRICS.name), REALTIME_METRICS.name).select(
        "metric_time", "metric_name", "metric_value", "dimension"))


def q_stream_raw_transactions(spark, sf):
    """Every transaction once, although the messages arrive in unordered
    files, one a micro-batch, and every tenth message twice."""
    paths = _paths(spark, "raw_transactions")
    messages = testdata.event_messages(spark, sf)
    again = messages.where(F.col("key").cast("bigint") % 10 == 0)
    messages.unionByName(again).select("value").repartition(4).write.text(f"{paths.root}/in")
    jobs.catch_up(jobs.raw_transactions_stream(text_stream(spark, f"{paths.root}/in", max_files_per_trigger=1)),
                  paths, TRANSACTIONS, "raw_transactions")
    cols = [c.name for c in TRANSACTIONS.columns if c.name != "created_at"]
    return plain(read_table(spark, paths.table(TRANSACTIONS.name), TRANSACTIONS.name).select(*cols))


def q_stream_raw_transactions_other_days(spark, sf):
    """Every seventh message is delivered again later, its time on another day; every
    transaction is stored once, as it came first."""
    paths = _paths(spark, "raw_other_days")
    again = testdata.event_messages(spark, sf, where=F.col("event_id") % 7 == 0, days_later=3)
    for messages in (testdata.event_messages(spark, sf), again):
        messages.select("value").repartition(2).write.mode("append").text(f"{paths.root}/in")
        jobs.catch_up(jobs.raw_transactions_stream(text_stream(spark, f"{paths.root}/in")), paths, TRANSACTIONS, "raw_transactions")
    stored = read_table(spark, paths.table(TRANSACTIONS.name), TRANSACTIONS.name)
    return plain(stored.select("transaction_id", "timestamp", "store_id", "customer_id", "final_amount"))


def q_stream_store_summary_panes(spark, sf):
    """The incremental summary stream from panes (two chained window aggregations)."""
    paths = _paths(spark, "store_panes")
    _in_slices(spark, paths, lambda rng: testdata.event_messages(spark, sf, rng),
               jobs.store_panes_stream, TRANSACTIONS_SUMMARY, "store_panes")
    return plain(read_summary(spark, paths.table(TRANSACTIONS_SUMMARY.name)).select(
        "window_start", "window_end", "store_id", "total_transactions", "total_revenue", "avg_transaction_value"))


def q_versioned_summary(spark, sf):
    """K7, atomic: earlier windows, then the batch, each one commit; read through the pointer."""
    existing, batch = _merge_sides(spark, sf)
    table = VersionedTable(spark, scratch_path(spark, "tables", "versioned_summary"), TUMBLING_SUMMARY)
    table.merge(existing)
    table.merge(batch)
    table.vacuum(keep=1)
    cols = [c.name for c in TUMBLING_SUMMARY.columns if c.name not in ("created_at", "customer_sketch")]
    return plain(table.read().select(*cols))


def q_merged_latency(spark, sf):
    """X1 from mergeable sketches, one a shipping month (average exact, P95 and P99 checked
    against the exact ranks of all rows)."""
    rows = _order_lines(spark, sf)
    path = scratch_path(spark, "sketches")
    progress.latency_sketches(rows, "o_orderdate", "l_shipdate", {"month": F.date_trunc("month", "l_shipdate")},
                              unit_ms=86_400_000).write.parquet(path)
    merged = progress.merged_latency(spark.read.parquet(path))
    found = merged.first()
    latency = F.datediff("l_shipdate", "o_orderdate")

    def within(value, p):
        """Whether the value's rank among all rows is ``p``, give or take the error."""
        rank = lambda cond: F.avg(F.coalesce(cond, F.lit(False)).cast("int"))
        return ((rank(latency < F.lit(value)) - progress.RANK_ERROR <= p)
                & (rank(latency <= F.lit(value)) + progress.RANK_ERROR >= p))

    return rows.agg(*[F.lit(v).cast("bigint").alias(n) for n, v in (
                        ("rows", found.rows), ("avg_latency", found.avg_latency),
                        ("least_latency", found.least), ("most_latency", found.most))],
                    within(found.p95_latency, 0.95).alias("p95_within"), within(found.p99_latency, 0.99).alias("p99_within"))


def _rollups(spark, sf) -> hierarchy.RollupLog:
    """Pre-aggregates of the summary, kept by the table's writer over two batches."""
    log = hierarchy.RollupLog(scratch_path(spark, "rollups"))
    writer = IdempotentBatchWriter(scratch_path(spark, "tables", "with_rollups"), TRANSACTIONS_SUMMARY, also=(log,))
    middle = P.STREAM_SLICE_BOUNDS[1]
    for batch_id, rng in enumerate((TimeRange(None, middle), TimeRange(middle, None))):
        writer(event_summary(spark, sf, rng), batch_id)
    return log


def q_rollup_totals_all_time(spark, sf):
    """Q12, Q14, Q15 over all time, from month nodes."""
    return plain(hierarchy.totals(hierarchy.nodes_of(_rollups(spark, sf).read(spark))))


def q_rollup_totals_of_range(spark, sf):
    """The same over a range: minutes and hours at its edges, days within, after a compaction."""
    log = _rollups(spark, sf)
    log.compact(spark, 2, scratch_path(spark, "staging", "rollups"))
    return plain(hierarchy.totals(hierarchy.nodes_of(log.read(spark), TimeRange(P.ROLLUP_START, P.ROLLUP_END))))


def q_polled_change(spark, sf):
    """U4: trailing-hour figures at every 5-second poll of a day, against the poll before."""
    rng = TimeRange(P.POLL_START, P.POLL_END)
    summary = event_summary(spark, sf, rng.widen(before=dt.timedelta(hours=1)))
    return plain(polls.polled_totals(summary, rng, dt.timedelta(seconds=P.POLL_SECONDS)))


def q_late_rows_repaired(spark, sf):
    """Two days reach the streams after the watermark has passed them. The summary
    drops them, the raw table keeps them, and the repair mends only their windows."""
    summary, raw = _paths(spark, "late_summary"), _paths(spark, "late_raw")
    late = testdata.event_time_between(P.LATE_START, P.LATE_END)
    for where in (~late, late):
        testdata.event_messages(spark, sf, where=where).select("value").write.mode("append").text(f"{summary.root}/in")
        source = lambda: text_stream(spark, f"{summary.root}/in")
        jobs.catch_up(jobs.store_summary_stream(source()), summary, TRANSACTIONS_SUMMARY, "store_window_summary",
                      state_partitions=default_parallelism(spark))
        jobs.catch_up(jobs.raw_transactions_stream(source()), raw, TRANSACTIONS, "raw_transactions")
    path = summary.table(TRANSACTIONS_SUMMARY.name)
    closed = read_summary(spark, path).agg(F.max("window_end")).first()[0]
    repair.repair_late_rows(spark, raw.table(TRANSACTIONS.name), path, closed)
    return plain(read_summary(spark, path).select(
        "window_start", "window_end", "store_id", "total_transactions", "total_revenue", "avg_transaction_value"))


def q_customer_sessions(spark, sf):
    """Sessions of every customer, from the customer-events messages as a table."""
    events = parse_messages(testdata.customer_messages(spark, sf), "customer_events")
    return plain(sessions.customer_sessions(events, f"{P.SESSION_GAP_MINUTES} minutes"))


def q_stream_customer_sessions(spark, sf):
    """S5 as an incremental stream: the sessions that the watermark has closed, from their table."""
    paths = _paths(spark, "customer_sessions")
    _in_slices(spark, paths, lambda rng: testdata.customer_messages(spark, sf, rng),
               lambda raw: jobs.session_stream(raw, f"{P.SESSION_GAP_MINUTES} minutes"), CUSTOMER_SESSIONS, "customer_sessions")
    cols = [c.name for c in CUSTOMER_SESSIONS.columns if c.name != "created_at"]
    return plain(read_table(spark, paths.table(CUSTOMER_SESSIONS.name), CUSTOMER_SESSIONS.name).select(*cols))


_STOCK_COLUMNS = ("store_id", "product_id", "updated_at", "event_id", "current_stock", "reorder_level", "reorder")


def q_stock_levels(spark, sf):
    """The latest stock of every store and product, from the inventory messages as a table."""
    events = parse_messages(testdata.inventory_messages(spark, sf), "inventory")
    return plain(latest.stock_levels(events).select(*_STOCK_COLUMNS))


def q_stream_stock_levels(spark, sf):
    """S4 as a stream in update mode: unordered files of bounded size, a tenth of the messages again, a
    third of the files a micro-batch; the keyed table read through its pointer.

    What is kept on disk at once is the messages (compressed), the state, one version of the table beside the
    one being written, and the shuffles of one step."""
    paths = _paths(spark, "stock_levels")
    # A compressed file is read by one task: as many a micro-batch as there are cores, at least.
    thirds = max(default_parallelism(spark), -(-_lines(spark, sf) // (3 * FILE_LINES)))
    messages = testdata.inventory_messages(spark, sf, again=F.col("l_orderkey") % 10 == 0, unordered=3 * thirds)
    conf = {"spark.sql.shuffle.partitions": str(default_parallelism(spark))} | DENSE_FILES | SHUFFLES_DROPPED
    with temporary_conf(spark, conf):
        messages.select("value").write.option("compression", "gzip").text(f"{paths.root}/in")
        query = jobs.run_stock(text_stream(spark, f"{paths.root}/in", max_files_per_trigger=thirds), paths,
                               {"availableNow": True}, buckets=8, keep=1)
        query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return plain(jobs.stock_table(spark, paths, 8).read().select(*_STOCK_COLUMNS))


def q_stream_open_windows(spark, sf):
    """Closed windows from the table and open ones from the stream's state; together all events."""
    paths = _paths(spark, "open_windows")
    testdata.event_messages(spark, sf).select("value").write.text(f"{paths.root}/in")
    jobs.catch_up(jobs.store_summary_stream(text_stream(spark, f"{paths.root}/in")), paths, TRANSACTIONS_SUMMARY,
                  "store_window_summary", state_partitions=default_parallelism(spark))
    stored = read_summary(spark, paths.table(TRANSACTIONS_SUMMARY.name))
    return plain(open_windows.with_open_windows(
        stored, open_windows.open_store_windows(spark, paths.checkpoint(TRANSACTIONS_SUMMARY.name))))


def q_streams_from_decoded(spark, sf):
    """Messages are parsed once; the three aggregating streams run on the decoded table, all at
    once on processing-time triggers. Rows and main figure of every table."""
    paths = _paths(spark, "decoded")
    testdata.event_messages(spark, sf, items=True).select("value").write.text(f"{paths.root}/in")
    every = {name: {"processingTime": "1 second"} for name in jobs.TRIGGERS}
    with temporary_conf(spark, {"spark.sql.shuffle.partitions": str(default_parallelism(spark))}):
        jobs.run_to_parquet(decoded.decode_stream(text_stream(spark, f"{paths.root}/in")), paths.table("decoded"),
                            paths.checkpoint("decoded"), query_name="decoded").awaitTermination()
        jobs.drain(jobs.start_from_decoded(spark, paths, every))
    return _table_figures(spark, paths)


def q_all_streams(spark, sf):
    """All streams at once on processing-time triggers, each on the topic; the same figures."""
    paths = _paths(spark, "all_streams")
    testdata.event_messages(spark, sf, items=True).select("value").write.text(f"{paths.root}/in")
    every = {name: {"processingTime": "1 second"} for name in (*jobs.TRIGGERS, "raw_transactions")}
    with temporary_conf(spark, {"spark.sql.shuffle.partitions": str(default_parallelism(spark))}):
        jobs.drain(jobs.start_retail_streams(spark, lambda: text_stream(spark, f"{paths.root}/in"), paths, every,
                                             raw_transactions=True))
    raw = read_table(spark, paths.table(TRANSACTIONS.name), TRANSACTIONS.name)
    return _table_figures(spark, paths).unionByName(raw.agg(
        F.lit(TRANSACTIONS.name).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.count("transaction_id").alias("total")))


def _table_figures(spark, paths) -> DataFrame:
    figure = lambda name, rows, total: rows.agg(
        F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.sum(total).cast("bigint").alias("total"))
    metrics = read_table(spark, paths.table(REALTIME_METRICS.name), REALTIME_METRICS.name)
    counted = F.when(F.col("metric_name") == "transactions_per_window", F.col("metric_value")).otherwise(0)
    return (figure(TRANSACTIONS_SUMMARY.name, read_summary(spark, paths.table(TRANSACTIONS_SUMMARY.name)), "total_transactions")
            .unionByName(figure(PRODUCT_PERFORMANCE.name, read_products(spark, paths.table(PRODUCT_PERFORMANCE.name)), "quantity_sold"))
            .unionByName(figure(REALTIME_METRICS.name, metrics, counted)))


def q_rates_of_whole_range(spark, sf):
    """U1, U5 over the whole range, where the figures (transactions by the fixed 60 and 3,600) are not 0."""
    rng = TimeRange(P.WHOLE_RANGE_START, P.WHOLE_RANGE_END)
    return plain(rollups.dashboard_cards(event_summary(spark, sf, rng), rng)).select(
        "transactions_per_minute", "events_per_second")


def q_streamed_then_backfilled_summary(spark, sf):
    """K7 over a streamed table: a third of one day's events reach the stream
    not at all; a re-load of that day puts its windows right."""
    paths = _paths(spark, "backfilled")
    lost = testdata.event_time_between(P.LOST_START, P.LOST_END) & (F.col("event_id") % 3 == 0)
    testdata.event_messages(spark, sf, where=~lost).select("value").write.text(f"{paths.root}/in")
    jobs.catch_up(jobs.store_summary_stream(text_stream(spark, f"{paths.root}/in")), paths, TRANSACTIONS_SUMMARY,
                  "store_window_summary", state_partitions=default_parallelism(spark))
    jobs.backfill(spark, testdata.event_messages(spark, sf), paths, TimeRange(P.BACKFILL_START, P.BACKFILL_END))
    return plain(read_summary(spark, paths.table(TRANSACTIONS_SUMMARY.name)).select(
        "window_start", "window_end", "store_id", "total_transactions", "total_revenue", "avg_transaction_value"))


def q_stream_progress(spark, sf):
    """Figures of a stream over all its runs, from the progress table; two days reach it
    after the watermark has passed them."""
    paths = _paths(spark, "progress")
    late = testdata.event_time_between(P.LATE_START, P.LATE_END)
    for where in (~late, late):
        testdata.event_messages(spark, sf, bad=True, where=where).select("value").write.mode("append").text(f"{paths.root}/in")
        jobs.catch_up(jobs.store_summary_stream(text_stream(spark, f"{paths.root}/in")), paths, TRANSACTIONS_SUMMARY,
                      "store_window_summary", state_partitions=default_parallelism(spark))
    figures = progress.stream_progress(progress.read_progress(spark, paths.progress(TRANSACTIONS_SUMMARY.name)))
    # Spark counts late rows after partial aggregation, so their number depends on the partitions.
    return figures.select("query_name", "input_rows", "total_records", "valid_records",
                          (F.col("rows_dropped_by_watermark") > 0).alias("late_rows_dropped"))


def q_processing_latency(spark, sf):
    """X1 on two stored times, here the order's and its lines' shipping: average, P95 and P99 in days."""
    return progress.processing_latency(_order_lines(spark, sf), "o_orderdate", "l_shipdate", unit_ms=86_400_000)


def _order_lines(spark, sf) -> DataFrame:
    orders = testdata.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = testdata.table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


_QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}


def _configured(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Query] = {name: _configured(fn) for name, fn in _QUERIES.items()}

FLAGSHIP = "store_window_summary"


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    return QUERIES[FLAGSHIP](spark, sf_dir)
