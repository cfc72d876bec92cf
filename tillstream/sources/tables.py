"""Scans of stored summary tables (S6, S7) with partition pruning.

Tables are Parquet partitioned by the date of their time column. Catalyst does
not derive a date predicate from a timestamp predicate, so the scan adds both:
the date bound prunes directories, the timestamp bound prunes row groups and
rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.functions.timebounds import TimeRange, in_range
from tillstream.schemas import (CUSTOMER_SESSIONS, PRODUCT_PERFORMANCE, REALTIME_METRICS, TRANSACTIONS,
                                TRANSACTIONS_SUMMARY)

TIME_COLUMN = {
    TRANSACTIONS_SUMMARY.name: ("window_start", "window_date"),
    "tumbling_summary": ("window_start", "window_date"),
    PRODUCT_PERFORMANCE.name: ("window_start", "window_date"),
    REALTIME_METRICS.name: ("metric_time", "metric_date"),
    TRANSACTIONS.name: ("timestamp", "event_date"),
    CUSTOMER_SESSIONS.name: ("session_start", "session_date"),
}


def _date_bound(rng: TimeRange, unit: str = "day") -> TimeRange:
    start = dt.datetime.combine(rng.start.date(), dt.time()) if rng.start else None
    if start and unit == "month":
        start = start.replace(day=1)
    end = (dt.datetime.combine(rng.end.date(), dt.time()) + dt.timedelta(days=1)) if rng.end else None
    return TimeRange(start, end)


#: Second partition column of every stored table (``sinks.parquet``).
BATCH_ID = "batch_id"


def stored_rows(spark: SparkSession, path: str, table: str) -> DataFrame:
    """All rows of a stored table with its partition columns.

    The contract's schema is given, so a file without one of its columns has
    NULL there, and a table without files is empty; a missing table raises.
    """
    from tillstream.schemas import CONTRACTS
    ddl = ", ".join(f"`{c.name}` {c.dtype}" for c in CONTRACTS[table].columns)
    return spark.read.schema(f"{ddl}, `{TIME_COLUMN[table][1]}` date, `{BATCH_ID}` bigint").parquet(path)


def read_table(spark: SparkSession, path: str, table: str, rng: TimeRange | None = None,
               unit: str = "day") -> DataFrame:
    """Rows of ``rng``: the date predicate prunes partitions (of ``unit``), the
    time predicate row groups."""
    df = stored_rows(spark, path, table).drop(BATCH_ID)
    if rng is None:
        return df
    ts_col, date_col = TIME_COLUMN[table]
    days = _date_bound(rng, unit)
    date_pred = F.lit(True)
    if days.start is not None:
        date_pred = date_pred & (F.col(date_col) >= F.lit(days.start.date()))
    if days.end is not None:
        date_pred = date_pred & (F.col(date_col) < F.lit(days.end.date()))
    return df.where(date_pred & in_range(ts_col, rng))


def read_summary(spark: SparkSession, path: str, rng: TimeRange | None = None) -> DataFrame:
    return read_table(spark, path, TRANSACTIONS_SUMMARY.name, rng)


def read_products(spark: SparkSession, path: str, rng: TimeRange | None = None, unit: str = "day") -> DataFrame:
    return read_table(spark, path, PRODUCT_PERFORMANCE.name, rng, unit)
