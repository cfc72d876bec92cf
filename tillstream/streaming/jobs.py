"""Streaming jobs.

The same window operators as in batch, under ``readStream ... writeStream``:
watermark on event time, append output, a mandatory checkpoint per query, and
all queries awaited together so a failure in any of them surfaces.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators import latest, sessions, windows
from tillstream.session import configure_streaming
from tillstream.functions.timebounds import TimeRange, in_range, parse_event_time, ts_literal
from tillstream.schemas import (PRODUCT_PERFORMANCE, REALTIME_METRICS, REQUIRED, STOCK_LEVELS, TRANSACTIONS,
                                TRANSACTIONS_SUMMARY, TableContract)
from tillstream.sinks.metrics import metrics_long
from tillstream.sinks.parquet import stream_to_table
from tillstream.sinks.versioned import VersionedTable
from tillstream.sources.decode import parse_messages, transactions_from_messages
from tillstream.streaming.decoded import decode_stream, decoded_source
from tillstream.streaming.progress import ProgressLog

# Trigger intervals of the three queries (store summary, products, metrics).
TRIGGERS = {
    "store_window_summary": {"processingTime": "10 seconds"},
    "product_window_performance": {"processingTime": "30 seconds"},
    "realtime_window_metrics": {"processingTime": "10 seconds"},
}


@dataclass
class StreamPaths:
    """Output table and checkpoint locations (shared storage on a cluster)."""
    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def progress(self, name: str) -> str:
        return f"{self.root}/progress/{name}"

    def rollups(self, name: str) -> str:
        return f"{self.root}/rollups/{name}"

    def latency(self, name: str) -> str:
        return f"{self.root}/latency/{name}"


# What each stream decodes of a message (the store summary also checks all required fields).
PRODUCT_FIELDS = ("timestamp", "items")
METRIC_FIELDS = ("timestamp", "transaction_id", "final_amount")


def store_summary_stream(raw: DataFrame, watermark: str | None = windows.DEFAULT_WATERMARK) -> DataFrame:
    tx = transactions_from_messages(raw, fields=REQUIRED["transactions"])
    return windows.store_window_summary(tx, watermark=watermark)


def product_stream(raw: DataFrame, watermark: str | None = windows.DEFAULT_WATERMARK) -> DataFrame:
    items = windows.explode_items(transactions_from_messages(raw, fields=PRODUCT_FIELDS))
    return windows.product_window_performance(items, watermark=watermark)


def metrics_stream(raw: DataFrame, watermark: str | None = windows.DEFAULT_WATERMARK) -> DataFrame:
    return windows.realtime_window_metrics(transactions_from_messages(raw, fields=METRIC_FIELDS),
                                           watermark=watermark)


def store_panes_stream(raw: DataFrame, watermark: str | None = windows.DEFAULT_WATERMARK) -> DataFrame:
    """The store summary from panes: two chained windowed aggregations (``pane_window_summary``)."""
    tx = transactions_from_messages(raw, fields=REQUIRED["transactions"])
    return windows.pane_window_summary(tx, watermark=watermark)


def session_stream(raw: DataFrame, gap: str = sessions.DEFAULT_GAP, watermark: str = "1 minute") -> DataFrame:
    """Customer sessions of the customer-events topic."""
    return sessions.customer_sessions(parse_messages(raw, "customer_events"), gap, watermark)


def stock_stream(raw: DataFrame) -> DataFrame:
    """Latest stock of every store and product of the inventory topic (update mode)."""
    return latest.stock_levels(parse_messages(raw, "inventory"))


#: Hash buckets of the stock table.
STOCK_BUCKETS = 64


def stock_table(spark: SparkSession, paths: StreamPaths, buckets: int = STOCK_BUCKETS) -> VersionedTable:
    """The keyed stock table: a key's bucket is rewritten when its stock has changed."""
    part = F.format_string("%04d", F.pmod(F.xxhash64(*STOCK_LEVELS.key), F.lit(buckets)))
    return VersionedTable(spark, paths.table(STOCK_LEVELS.name), STOCK_LEVELS, part, by_key=True)


def run_stock(raw: DataFrame, paths: StreamPaths, trigger: dict | None = None, name: str = "stock_levels",
              buckets: int = STOCK_BUCKETS, keep: int | None = None) -> StreamingQuery:
    """Keep the stock table up to date: each micro-batch's changed keys replace their rows, in
    one commit that also names the batch, so a replayed batch changes nothing.

    ``keep``: after each micro-batch, versions that the last ``keep`` commits do not name are
    removed (unset: none are); readers of older commits must be done by then."""
    spark = raw.sparkSession
    configure_streaming(spark)
    table = stock_table(spark, paths, buckets)

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, name, batch_id)
        if keep is not None:
            table.vacuum(keep)

    return (stock_stream(raw).writeStream.outputMode("update").queryName(name)
            .option("checkpointLocation", paths.checkpoint(name))
            .foreachBatch(merge)
            .trigger(**(trigger or TRIGGERS["store_window_summary"])).start())


RAW_COLUMNS = ("transaction_id", "timestamp", "store_id", "customer_id", "customer_type",
               "total_amount", "payment_method", "discount_applied", "final_amount")


def raw_transactions_stream(raw: DataFrame) -> DataFrame:
    """Transactions without items. No watermark, so late messages are kept;
    one row per id is the keyed write's part (``stream_to_table(insert_only=True)``)."""
    tx = transactions_from_messages(raw, fields=RAW_COLUMNS)
    return tx.drop("timestamp").withColumnRenamed("event_time", "timestamp").select(*RAW_COLUMNS)


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                   partition_by: tuple[str, ...] = (), query_name: str | None = None) -> StreamingQuery:
    """Start an append-mode stream into a Parquet folder."""
    configure_streaming(df.sparkSession)
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def run_with_batch_writer(df: DataFrame, writer, checkpoint: str, trigger: dict | None = None,
                          query_name: str | None = None) -> StreamingQuery:
    """Append-mode stream whose micro-batches go to ``writer(batch_df,
    batch_id)`` (``sinks.parquet.IdempotentBatchWriter``,
    ``sinks.jdbc.JdbcBatchWriter``). A batch replayed after a failure calls
    the writer again with the same id; both writers make that a no-op."""
    configure_streaming(df.sparkSession)
    w = (df.writeStream.outputMode("append").foreachBatch(writer)
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or TRIGGERS["store_window_summary"])).start()


def run_to_console(df: DataFrame, trigger: dict | None = None, truncate: bool = False,
                   query_name: str | None = None) -> StreamingQuery:
    """K4: print each micro-batch's emitted rows (monitoring; no checkpoint
    is needed for a console sink, none is kept)."""
    configure_streaming(df.sparkSession)
    writer = (df.writeStream.format("console").outputMode("append")
              .option("truncate", str(truncate).lower()))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.trigger(**(trigger or TRIGGERS["realtime_window_metrics"])).start()


def run_until_caught_up(df: DataFrame, path: str, checkpoint: str,
                        state_partitions: int | None = None, **kw) -> StreamingQuery:
    """Process everything available now (plus the closing no-data batch that
    emits windows the watermark has passed), then stop.

    ``state_partitions`` fixes the number of state-store partitions of a new
    checkpoint (it cannot change later; AQE does not coalesce stateful
    shuffles). Unset, the session's ``spark.sql.shuffle.partitions`` applies.
    """
    from tillstream.session import temporary_conf
    conf = {"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {}
    with temporary_conf(df.sparkSession, conf):
        q = run_to_parquet(df, path, checkpoint, {"availableNow": True}, **kw)
        q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def start_retail_streams(spark: SparkSession, source: Callable[[], DataFrame], paths: StreamPaths,
                         triggers: dict[str, dict] | None = None,
                         raw_transactions: bool = False,
                         logs: list[ProgressLog] | None = None) -> list[StreamingQuery]:
    """Start the three queries on one message source (and, optionally,
    the raw transactions table).

    ``source`` builds a fresh streaming DataFrame (``kafka_stream`` or
    ``text_stream``) for each query; each query has its own checkpoint.
    ``logs`` receives the progress logs, to ``save(least=1)`` at the end.
    """
    configure_streaming(spark)
    triggers = {**TRIGGERS, **(triggers or {})}
    jobs = [
        ("store_window_summary", store_summary_stream, TRANSACTIONS_SUMMARY),
        ("product_window_performance", product_stream, PRODUCT_PERFORMANCE),
        ("realtime_window_metrics", lambda raw: metrics_long(metrics_stream(raw)), REALTIME_METRICS),
    ]
    if raw_transactions:
        jobs.append(("raw_transactions", raw_transactions_stream, TRANSACTIONS))
    started = [start_stream(build(source()), paths, contract, name,
                            triggers.get(name, triggers["store_window_summary"]))
               for name, build, contract in jobs]
    if logs is not None:
        logs.extend(started)
    return [log.query for log in started]


def start_decoded_streams(raw: DataFrame, paths: StreamPaths, triggers: dict[str, dict] | None = None,
                          logs: list[ProgressLog] | None = None) -> list[StreamingQuery]:
    """T9 with one parse: a decoding stream over the topic, and the three aggregating
    streams on its table, each with its own checkpoint and the same outputs as
    ``start_retail_streams``."""
    spark = raw.sparkSession
    triggers = {**TRIGGERS, **(triggers or {})}
    trigger = triggers.get("decoded", TRIGGERS["store_window_summary"])
    first = run_to_parquet(decode_stream(raw), paths.table("decoded"), paths.checkpoint("decoded"), trigger, query_name="decoded")
    if "availableNow" in trigger:  # the others see what is decoded when they start
        first.awaitTermination()
    return [first, *start_from_decoded(spark, paths, triggers, logs)]


def start_from_decoded(spark: SparkSession, paths: StreamPaths, triggers: dict[str, dict],
                       logs: list[ProgressLog] | None = None) -> list[StreamingQuery]:
    """The three aggregating streams on the decoded table (whose folder may still be empty)."""
    from tillstream.sinks.parquet import _file_system
    place, files = _file_system(spark, paths.table("decoded"))
    files.mkdirs(place)
    jobs = [
        ("store_window_summary", windows.store_window_summary, TRANSACTIONS_SUMMARY),
        ("product_window_performance", lambda tx: windows.product_window_performance(windows.explode_items(tx)), PRODUCT_PERFORMANCE),
        ("realtime_window_metrics", lambda tx: metrics_long(windows.realtime_window_metrics(tx)), REALTIME_METRICS),
    ]
    started = [start_stream(build(decoded_source(spark, paths.table("decoded"))), paths, contract, name, triggers[name])
               for name, build, contract in jobs]
    if logs is not None:
        logs.extend(started)
    return [log.query for log in started]


def drain(queries: list[StreamingQuery]) -> None:
    """Wait until running queries have handled everything available (their closing windows included), then stop them."""
    for query in queries:
        query.processAllAvailable()
    for query in queries:
        query.stop()


def start_stream(df: DataFrame, paths: StreamPaths, contract: TableContract, name: str,
                 trigger: dict | None = None, also: tuple = ()) -> ProgressLog:
    """One stream into its stored table, with its progress log (whose ``query`` it is)."""
    log = ProgressLog(df.sparkSession, paths.progress(contract.name))
    stream_to_table(df, paths.table(contract.name), paths.checkpoint(contract.name), contract, trigger,
                    name, insert_only=contract is TRANSACTIONS, progress=log, also=also)
    return log


def catch_up(df: DataFrame, paths: StreamPaths, contract: TableContract, name: str,
             state_partitions: int | None = None, also: tuple = ()) -> ProgressLog:
    """``start_stream`` over everything available now, to its end (see ``run_until_caught_up``)."""
    from tillstream.session import temporary_conf
    conf = {"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {}
    with temporary_conf(df.sparkSession, conf):
        log = start_stream(df, paths, contract, name, {"availableNow": True}, also)
        log.finish()
    return log


def await_all(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait until every query has stopped; the first failure ends the wait
    and is raised (instead of hiding behind another query's endless wait).
    A query that stops normally does not end the wait for the others."""
    while True:
        for q in queries:
            if q.exception() is not None:
                raise q.exception()
        if not any(q.isActive for q in queries):
            return
        spark.streams.awaitAnyTermination()
        spark.streams.resetTerminated()


#: Window starts of all stored tables lie on a grid that divides this.
GRID = dt.timedelta(minutes=5)


def backfill(spark: SparkSession, raw: DataFrame, paths: StreamPaths, rng: TimeRange) -> None:
    """Re-load the messages of ``rng`` (``kafka_batch`` or ``spark.read.text``)
    into the stored tables with the same operators as the streams.

    ``raw`` must hold all messages of the range; others are left out. Only
    windows wholly inside the range are replaced (the re-loaded row wins): one
    that the range cuts would be rebuilt from a part of its events. The bounds
    must lie on the tables' common window grid. Tables are merged by key and
    only days with re-loaded windows are rewritten.
    """
    from tillstream.session import scratch_path
    from tillstream.sinks.parquet import merge_into_table

    for t in (rng.start, rng.end):
        if t is None or (t - dt.datetime.min) % GRID:
            raise ValueError(f"a re-load needs bounds on full {GRID} steps, not {t}")
    tx = raw.where(in_range(parse_event_time(F.get_json_object(F.col("value").cast("string"), "$.timestamp")), rng))
    outputs = [
        (store_summary_stream(tx, watermark=None), TRANSACTIONS_SUMMARY, "window_start", "1 MINUTE"),
        (product_stream(tx, watermark=None), PRODUCT_PERFORMANCE, "window_start", "5 MINUTES"),
        (metrics_long(metrics_stream(tx, watermark=None)), REALTIME_METRICS, "metric_time", "30 SECONDS"),
    ]
    for df, contract, start, length in outputs:
        whole = (F.col(start) >= ts_literal(rng.start)) & (F.col(start) + F.expr(f"INTERVAL {length}") <= ts_literal(rng.end))
        merge_into_table(df.where(whole), paths.table(contract.name), contract,
                         scratch_path(spark, "staging", contract.name))
