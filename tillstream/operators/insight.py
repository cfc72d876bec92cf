"""Figures the dashboard showed as made-up values, computed for real
(X2 velocity, X3 data quality, X4 heatmap, X6 exact summary)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.functions.money import MEAN, TOTAL, exact_mean, money, round_half_up_ratio
from tillstream.functions.timebounds import TimeRange, in_range, ts_literal
from tillstream.plans.broadcast import broadcast_bounded

# Heatmap row labels, ISO order (1 = Monday ... 7 = Sunday).
DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
HOURS_PER_DAY = 24
HEATMAP_CELLS = len(DAY_NAMES) * HOURS_PER_DAY


def iso_day_of_week(c) -> F.Column:
    """1 = Monday ... 7 = Sunday (Spark's ``dayofweek`` is 1 = Sunday)."""
    return ((F.dayofweek(c) + 5) % 7 + 1).cast("int")


def transaction_velocity(tx: DataFrame, as_of: dt.datetime, minutes: int = 20) -> DataFrame:
    """Transactions per minute for the ``minutes`` minutes before
    ``as_of``; minutes without transactions appear with 0."""
    spark: SparkSession = tx.sparkSession
    start = as_of - dt.timedelta(minutes=minutes)
    rng = TimeRange(start, as_of)
    counts = (tx.where(in_range("event_time", rng))
              .groupBy(F.date_trunc("minute", "event_time").alias("minute_start"))
              .agg(F.count("transaction_id").alias("transactions")))
    grid = spark.range(minutes).select(
        F.timestamp_add("MINUTE", F.col("id").cast("int"), ts_literal(start)).alias("minute_start"))
    # Both sides hold at most ``minutes`` rows: the grid by construction, the
    # counts because their key is the minute inside the same range.
    return (grid.join(broadcast_bounded(counts, minutes), "minute_start", "left")
            .select("minute_start",
                    F.coalesce("transactions", F.lit(0)).cast("bigint").alias("transactions")))


def activity_heatmap(tx: DataFrame, rng: TimeRange | None = None) -> DataFrame:
    """Transactions and revenue by day of week x hour, all 168 cells.

    Map-side partial aggregation leaves at most 168 rows per task before the
    shuffle, whatever the input size.
    """
    spark: SparkSession = tx.sparkSession
    src = tx if rng is None else tx.where(in_range("event_time", rng))
    cells = src.groupBy(
        iso_day_of_week("event_time").alias("day_of_week"),
        F.hour("event_time").alias("hour"),
    ).agg(F.count("transaction_id").alias("transactions"),
          F.sum(money("final_amount")).cast(TOTAL).alias("revenue"))
    names = F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), F.col("day_of_week"))
    grid = spark.range(HEATMAP_CELLS).select(
        (F.floor(F.col("id") / HOURS_PER_DAY) + 1).cast("int").alias("day_of_week"),
        (F.col("id") % HOURS_PER_DAY).cast("int").alias("hour"))
    return (grid.join(broadcast_bounded(cells, HEATMAP_CELLS), ["day_of_week", "hour"], "left")
            .select("day_of_week", names.alias("day_name"), "hour",
                    F.coalesce("transactions", F.lit(0)).cast("bigint").alias("transactions"),
                    F.coalesce("revenue", F.lit(0).cast(TOTAL)).alias("revenue")))


def summary_exact(tx: DataFrame, rng: TimeRange | None = None, store: str | None = None) -> DataFrame:
    """The trailing summary from raw transactions: each transaction once,
    weighted mean, exact distinct customers. Zeros when the range is empty."""
    src = tx if rng is None else tx.where(in_range("event_time", rng))
    if store is not None:
        src = src.where(F.col("store_id") == F.lit(store))
    return src.agg(
        F.count("transaction_id").alias("total_transactions"),
        F.coalesce(F.sum(money("final_amount")).cast(TOTAL), F.lit(0).cast(TOTAL)).alias("total_revenue"),
        F.coalesce(exact_mean("final_amount", MEAN), F.lit(0).cast(MEAN)).alias("avg_transaction_value"),
        F.count_distinct("customer_id").alias("total_customers"),
    )


def data_quality(parsed: DataFrame) -> DataFrame:
    """Valid / total * 100 over decoded messages (``sources.decode``),
    rounded half up to two decimals."""
    valid = F.sum(F.col("is_valid").cast("bigint"))
    return parsed.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(valid, F.lit(0)).alias("valid_records"),
    ).select(
        "total_records", "valid_records",
        (F.col("total_records") - F.col("valid_records")).alias("invalid_records"),
        round_half_up_ratio(F.col("valid_records") * 100, F.col("total_records"), 2,
                            "decimal(5,2)").alias("quality_pct"),
    )


def reject_reasons(parsed: DataFrame, kind: str = "transactions") -> DataFrame:
    """X3 detail: rejected messages per reason (first failing rule)."""
    from tillstream.schemas import REQUIRED
    from tillstream.sources.decode import reject_reason
    return (parsed.where(~F.col("is_valid"))
            .groupBy(reject_reason(REQUIRED[kind]).alias("reason"))
            .agg(F.count(F.lit(1)).alias("messages")))


def approx_distinct_check(tx: DataFrame, key: str = "store_id", tolerance: float = 0.15) -> DataFrame:
    """G4 check: the approximate distinct customer count per key lies within
    ``tolerance`` of the exact one."""
    agg = tx.groupBy(key).agg(
        F.approx_count_distinct("customer_id").alias("approx_customers"),
        F.count_distinct("customer_id").alias("exact_customers"))
    within = F.abs(F.col("approx_customers") - F.col("exact_customers")) <= F.col("exact_customers") * tolerance
    return agg.select(key, "exact_customers", "approx_customers", within.alias("within_tolerance"))
