"""The dashboard's metrics request (Q4-Q7 together) over one shared base.

Each poll asks four questions about the same trailing hour. The hour's
summary and product rows are persisted once and every answer is derived from
them (the 5-minute activity count is a sub-range of the same base), instead of
scanning the stored tables four times.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tillstream.functions.timebounds import TimeRange, in_range, trailing
from tillstream.operators import rollups


class MetricsSnapshot:
    """``summary``, ``stores``, ``products`` and ``recent_activity`` for one
    ``as_of``. Use as a context manager (or call ``close``) to release the
    persisted base."""

    def __init__(self, summary: DataFrame, products: DataFrame, as_of: dt.datetime,
                 span: str = "1h", recent: str = "5m", until: dt.datetime | None = None, k: int = 10):
        self.hour: TimeRange = trailing(as_of, span, until)
        self.recent_range: TimeRange = trailing(as_of, recent, until)
        self.base = summary.where(in_range("window_start", self.hour)).persist()
        self.product_base = products.where(in_range("window_start", self.hour)).persist()
        self.summary = rollups.summary_totals(self.base)
        self.stores = rollups.top_stores(self.base, k=k)
        self.products = rollups.top_products(self.product_base, k=k)
        self.recent_activity = rollups.recent_activity(self.base, self.recent_range)

    def close(self) -> None:
        self.base.unpersist()
        self.product_base.unpersist()

    def __enter__(self) -> "MetricsSnapshot":
        return self

    def __exit__(self, *exc) -> None:
        self.close()


def metrics_response(summary: DataFrame, products: DataFrame, as_of: dt.datetime, **kw) -> dict:
    """The metrics request as a dict: counts as int, money as float, product
    quantity and revenue as text. Every part is bounded (one row, the top-k
    lists, one count), so only those few rows reach the driver."""
    with MetricsSnapshot(summary, products, as_of, **kw) as snap:
        s = snap.summary.first()
        return {
            "summary": {
                "total_transactions": int(s.total_transactions),
                "total_revenue": float(s.total_revenue),
                "avg_transaction_value": float(s.avg_transaction_value),
                "total_customers": int(s.total_customers),
            },
            "stores": [
                {"store_id": r.store_id, "transactions": int(r.transactions),
                 "revenue": float(r.revenue), "avg_transaction": float(r.avg_transaction)}
                for r in snap.stores.collect()
            ],
            "products": [
                {"product_name": r.product_name, "category": r.category,
                 "quantity": str(r.quantity), "revenue": str(r.revenue)}
                for r in snap.products.collect()
            ],
            "recent_activity": int(snap.recent_activity.first().recent_count),
        }
