"""Repair of the summary after late rows (T6), driven by what has changed.

A row that comes after its window was emitted is dropped by the watermark, but
the raw transactions table keeps it. Windows whose raw count differs from their
stored one are found by one counting aggregation; only their rows are aggregated
in full, and only the days they lie in are rewritten.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.functions.money import MEAN, MONEY, exact_mean, money_sum
from tillstream.functions.timebounds import TimeRange, in_range, ts_literal
from tillstream.schemas import TRANSACTIONS, TRANSACTIONS_SUMMARY
from tillstream.sources.tables import read_summary, read_table

WINDOW, SLIDE = "1 minute", "30 seconds"


def _windowed(raw: DataFrame) -> DataFrame:
    """One row per raw transaction and sliding window that it lies in."""
    return raw.select(F.window("timestamp", WINDOW, SLIDE).alias("window"), "store_id", "transaction_id",
                      "customer_id", "final_amount")


def stale_windows(raw: DataFrame, summary: DataFrame, closed_until: dt.datetime) -> DataFrame:
    """(window_start, store_id) of the windows ended by ``closed_until`` whose stored count is not that of ``raw``."""
    counted = (_windowed(raw).groupBy("window", "store_id").agg(F.count("transaction_id").alias("n"))
               .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "store_id", "n")
               .where((F.col("window_end") <= ts_literal(closed_until)) & F.col("store_id").isNotNull()))
    stored = summary.select("window_start", "store_id", F.col("total_transactions").alias("stored"))
    return (counted.join(stored, ["window_start", "store_id"], "left")
            .where(~F.col("n").eqNullSafe(F.col("stored"))).select("window_start", "store_id"))


def rebuilt(raw: DataFrame, stale: DataFrame) -> DataFrame:
    """Summary rows of the stale windows, from their raw transactions (distinct customers exact)."""
    rows = _windowed(raw).withColumn("window_start", F.col("window.start"))
    return (rows.join(stale, ["window_start", "store_id"], "left_semi").groupBy("window", "store_id").agg(
        F.count("transaction_id").alias("total_transactions"), money_sum("final_amount", MONEY).alias("total_revenue"),
        exact_mean("final_amount", MEAN).alias("avg_transaction_value"),
        F.count_distinct("customer_id").alias("unique_customers"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "store_id",
                "total_transactions", "total_revenue", "avg_transaction_value", "unique_customers"))


def repair_late_rows(spark: SparkSession, raw_path: str, summary_path: str, closed_until: dt.datetime,
                     rng: TimeRange | None = None) -> int:
    """Bring the stored summary to what the raw table holds (of ``rng``, on the window grid); returns the windows mended."""
    from tillstream.session import scratch_path
    from tillstream.sinks.parquet import merge_into_table

    raw = read_table(spark, raw_path, TRANSACTIONS.name, rng)
    found = scratch_path(spark, "repair")
    whole = in_range("window_start", rng) if rng is not None else F.lit(True)
    stale_windows(raw, read_summary(spark, summary_path), closed_until).where(whole).write.parquet(found)
    stale = spark.read.schema("window_start timestamp, store_id string").parquet(found)
    n = stale.count()
    if n:
        merge_into_table(rebuilt(raw, stale), summary_path, TRANSACTIONS_SUMMARY,
                         scratch_path(spark, "staging", TRANSACTIONS_SUMMARY.name))
    return n
