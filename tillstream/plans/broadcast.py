"""Broadcast only what has a proven size bound.

``broadcast_bounded`` is for sides whose row count is bounded by construction
(a 168-cell grid, an aggregate keyed by such a grid) and states the bound.
Everything else is left to
``spark.sql.autoBroadcastJoinThreshold`` + AQE, which broadcast only sides
whose measured size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def broadcast_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast a side whose row count is at most ``max_rows`` by construction."""
    if max_rows > 1_000_000:
        raise ValueError(f"bound {max_rows} too large to broadcast")
    return F.broadcast(df)
