"""Figures of the windows that a stream has not emitted yet (T10), read from its state.

In append mode a window appears once the watermark has passed its end. Until then
its partial aggregate stands in the state store; Spark's state data source reads
it from the checkpoint, without touching the running query. Stored rows and open
ones together are the figures over everything received.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from tillstream.functions.money import MEAN, MONEY


def state_rows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """(key, value) of a query's windowed aggregation as of its last (or the given) batch.

    The value's fields are numbered: a plan's buffers may share a name.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    rows = reader.load(checkpoint)
    kept = rows.schema["value"].dataType
    numbered = StructType([StructField(f"b{i}", f.dataType) for i, f in enumerate(kept.fields)])
    return rows.select("key", F.col("value").cast(numbered).alias("value"))


def open_store_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Open windows of the store summary stream: start, end, store, transactions, revenue and mean so far.

    Buffers in the order of the aggregates: transactions; the amounts' sum and
    whether it is empty; the number of amounts; the customer sketch's words.
    """
    rows = state_rows(spark, checkpoint)
    fields = [f.name for f in rows.schema["key"].dataType.fields]
    window, store = (F.col("key").getField(name) for name in fields)
    total, n = F.col("value.b1"), F.col("value.b3")
    return rows.select(
        window["start"].alias("window_start"), window["end"].alias("window_end"), store.alias("store_id"),
        F.col("value.b0").alias("total_transactions"), total.cast(MONEY).alias("total_revenue"),
        (total / F.when(n > 0, n)).cast(MEAN).alias("avg_transaction_value"))


def with_open_windows(stored: DataFrame, open_rows: DataFrame) -> DataFrame:
    """Stored rows and open ones, each with ``closed``; a window that was emitted is not open any more."""
    cols = open_rows.columns
    return stored.select(*cols, F.lit(True).alias("closed")).unionByName(
        open_rows.select(*cols, F.lit(False).alias("closed")))
