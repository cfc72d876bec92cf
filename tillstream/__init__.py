"""tillstream: Spark-native retail stream analytics.

Transactions arrive as JSON messages (Kafka or files), are decoded and checked,
aggregated per store, per product and overall in event-time windows, stored as
date-partitioned Parquet (or JDBC), and rolled up into trailing-range reports.

Every transform is a ``DataFrame -> DataFrame`` function that runs unchanged on
batch and streaming input.
"""

from tillstream.session import configure, checkpoint_root  # noqa: F401

__all__ = ["configure", "checkpoint_root"]
