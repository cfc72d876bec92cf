"""Latest state by key (S4): stock level of every product in every store.

Of a key's events the one of the latest time counts (of one time, that of the
greatest event id), whatever order they arrive in. One aggregate with map-side
combine finds it; on a stream the same aggregate runs in update mode, and a
keyed table replaces a key's row with a later one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

STOCK_KEY = ("store_id", "product_id")


def latest_by_key(events: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row a key: the event that is greatest in ``order``."""
    rest = [c for c in events.columns if c not in (*key, *order)]
    latest = F.max(F.struct(*order, F.struct(*rest).alias("rest"))).alias("last")
    return (events.groupBy(*key).agg(latest).select(*key, *[F.col(f"last.{c}") for c in order], "last.rest.*")
            .select(*events.columns))


def stock_levels(events: DataFrame) -> DataFrame:
    """Per store and product: the last known stock and whether it has to be reordered.

    ``events``: decoded inventory messages. One without a key or time is left out.
    """
    told = events.where(F.col("store_id").isNotNull() & F.col("product_id").isNotNull() & F.col("event_time").isNotNull())
    last = latest_by_key(told.select(
        *STOCK_KEY, "event_time", "event_id", "product_name", "event_type", "current_stock", "reorder_level"),
        STOCK_KEY, ("event_time", "event_id"))
    return last.select(
        *STOCK_KEY, F.col("event_time").alias("updated_at"), "event_id", "product_name", "event_type", "current_stock",
        "reorder_level", F.coalesce(F.col("current_stock") <= F.col("reorder_level"), F.lit(False)).alias("reorder"))
