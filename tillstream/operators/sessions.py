"""Customer sessions (S5): consecutive events of a customer with no longer a gap between them.

The same function runs on a table and on a stream, where the session's state
merges as late and out-of-order events join what lies around them, and a
session is emitted once the watermark has passed its end. Partial sessions are
merged map-side on tables, so a frequent customer's events are reduced before
they move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DEFAULT_GAP = "30 minutes"


def customer_sessions(events: DataFrame, gap: str = DEFAULT_GAP, watermark: str | None = "1 minute") -> DataFrame:
    """Per customer and session: start, end (the last event's time), duration, events, page views, and what was used.

    Two events a gap apart still belong together. Events without a customer or a time belong to no session.
    """
    df = events.where(F.col("customer_id").isNotNull() & F.col("event_time").isNotNull())
    if events.isStreaming and watermark:
        df = df.withWatermark("event_time", watermark)
    agg = df.groupBy(F.session_window("event_time", gap).alias("session"), "customer_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum("page_views").cast("bigint").alias("page_views"),
        F.max("event_time").alias("session_end"),
        F.min_by("store_id", F.struct("event_time", "event_id")).alias("first_store"),
        F.max_by("event_type", F.struct("event_time", "event_id")).alias("last_event_type"))
    return agg.select(
        "customer_id", F.col("session.start").alias("session_start"), "session_end",
        (F.unix_micros("session_end") - F.unix_micros("session.start")).alias("duration_us"),
        "events", "page_views", "first_store", "last_event_type")
