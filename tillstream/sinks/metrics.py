"""Window metrics in long form ``(metric_time, metric_name,
metric_value, dimension)`` via ``unpivot``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

METRIC_COLUMNS = ("transactions_per_window", "revenue_per_window", "avg_transaction_value")


def metrics_long(metrics: DataFrame, dimension: str = "all",
                 measures: tuple[str, ...] = METRIC_COLUMNS) -> DataFrame:
    """``metrics`` has a ``window`` struct and the measure columns
    (``operators.windows.realtime_window_metrics``)."""
    wide = metrics.select(
        F.col("window.start").alias("metric_time"),
        F.lit(dimension).alias("dimension"),
        *[F.col(m).cast("decimal(10,2)").alias(m) for m in measures])
    return (wide.unpivot(["metric_time", "dimension"], list(measures), "metric_name", "metric_value")
            .select("metric_time", "metric_name", "metric_value", "dimension"))
