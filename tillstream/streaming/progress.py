"""Stream progress and latency as DataFrames (X5 stream_progress, X1 processing_latency).

Spark keeps only a query's last reports. ``ProgressLog`` stores every batch's
report as a row of a table below the output root, every few batches (before
Spark drops any) and when the query has ended, so the figures cover all batches
of all runs. A batch that is replayed replaces its row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

PROGRESS_SCHEMA = StructType([
    StructField("query_name", StringType()),
    StructField("batch_id", LongType()),
    StructField("timestamp", StringType()),
    StructField("num_input_rows", LongType()),
    StructField("input_rows_per_second", DoubleType()),
    StructField("processed_rows_per_second", DoubleType()),
    StructField("trigger_ms", LongType()),
    StructField("add_batch_ms", LongType()),
    StructField("rows_dropped_by_watermark", LongType()),
    StructField("state_rows", LongType()),
    StructField("watermark", StringType()),
    StructField("total_records", LongType()),
    StructField("valid_records", LongType()),
])


def _row(name: str | None, p: dict) -> tuple:
    dur = p.get("durationMs") or {}
    ops = p.get("stateOperators") or []
    dropped = sum(int(o.get("numRowsDroppedByWatermark", 0) or 0) for o in ops)
    state = sum(int(o.get("numRowsTotal", 0) or 0) for o in ops)
    num = lambda v: None if v is None or v != v else float(v)  # noqa: E731  (NaN -> NULL)
    quality = (p.get("observedMetrics") or {}).get("data_quality") or {}
    quality = quality.asDict() if hasattr(quality, "asDict") else dict(quality)
    return (name, int(p["batchId"]), p.get("timestamp"), int(p.get("numInputRows", 0)),
            num(p.get("inputRowsPerSecond")), num(p.get("processedRowsPerSecond")),
            int(dur.get("triggerExecution", 0)), int(dur.get("addBatch", 0)),
            dropped, state, (p.get("eventTime") or {}).get("watermark"),
            quality.get("total_records"), quality.get("valid_records"))


class ProgressLog:
    """The progress table of one query at ``path``, partitioned by batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.query: StreamingQuery | None = None
        self.saved = -1

    def follow(self, query: StreamingQuery) -> None:
        self.query = query

    def save(self, least: int | None = None) -> None:
        """Store the reports not stored yet, once there are ``least`` of them
        (default: ten, or half of what Spark keeps if that is less)."""
        if self.query is None:
            return
        if least is None:
            kept = int(self.spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"))
            least = max(1, min(10, kept // 2))
        rows = [_row(self.query.name, p) for p in self.query.recentProgress if int(p["batchId"]) > self.saved]
        if len(rows) >= least:
            (self.spark.createDataFrame(list({r[1]: r for r in rows}.values()), PROGRESS_SCHEMA)
             .coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(self.path))
            self.saved = max(r[1] for r in rows)

    def finish(self) -> None:
        """Wait for the query's end, raise its failure, store its last reports."""
        self.query.awaitTermination()
        self.save(least=1)
        if self.query.exception() is not None:
            raise self.query.exception()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema(PROGRESS_SCHEMA).parquet(path)
            .withColumn("timestamp", F.to_timestamp("timestamp")))


def stream_progress(progress: DataFrame) -> DataFrame:
    """Per query: batches, input rows, mean rows/s, dropped late rows,
    state rows at the end, last update."""
    return progress.groupBy("query_name").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("num_input_rows").alias("input_rows"),
        F.avg("processed_rows_per_second").alias("avg_processed_rows_per_second"),
        F.sum("rows_dropped_by_watermark").alias("rows_dropped_by_watermark"),
        F.max_by("state_rows", "batch_id").alias("state_rows"),
        F.max("timestamp").alias("last_update"),
        F.sum("total_records").alias("total_records"),
        F.sum("valid_records").alias("valid_records"),
    )


def batch_times(progress: DataFrame) -> DataFrame:
    """Per query: run time of the batches that read data (trigger start to sink commit)."""
    data = progress.where(F.col("num_input_rows") > 0)
    return data.groupBy("query_name").agg(
        F.count(F.lit(1)).alias("batches"),
        F.avg("trigger_ms").alias("avg_ms"),
        F.percentile_approx("trigger_ms", 0.95).alias("p95_ms"),
        F.percentile_approx("trigger_ms", 0.99).alias("p99_ms"),
    )


#: Size of a KLL sketch, and the rank error that it keeps (99 % confidence; that of k = 800 is 0.4 %).
SKETCH_K, RANK_ERROR = 800, 0.01


def _latency(event_time: str, write_time: str, unit_ms: int):
    millis = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    return F.floor((millis(write_time) - millis(event_time)) / unit_ms).cast("bigint")


def latency_sketches(rows: DataFrame, event_time: str, write_time: str, by: dict, unit_ms: int = 1) -> DataFrame:
    """X1 in mergeable parts: per group of ``by`` (name -> column; a micro-batch, an hour)
    the rows, the sum, least and greatest latency, and a KLL sketch of all of them.

    A sketch has a fixed size, whatever number of distinct latencies it stands
    for, and partial sketches combine map-side. Rows without either time are left out.
    """
    each = rows.select(*[c.alias(name) for name, c in by.items()],
                       _latency(event_time, write_time, unit_ms).alias("latency")).where(F.col("latency").isNotNull())
    return each.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("latency").alias("total"), F.min("latency").alias("least"),
        F.max("latency").alias("most"), F.kll_sketch_agg_bigint("latency", F.lit(SKETCH_K)).alias("sketch"))


def merged_latency(sketches: DataFrame, *by: str) -> DataFrame:
    """X1 over any set of ``latency_sketches``: rows and average (exact, rounded half up),
    P95 and P99 (values that occur, their rank within ``RANK_ERROR``), least and greatest."""
    from tillstream.functions.money import round_half_up_ratio
    grouped = sketches.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.min("least").alias("least"),
        F.max("most").alias("most"), F.kll_merge_agg_bigint("sketch").alias("sketch"))
    low = F.least("least", F.lit(0))  # the exact rounding is for non-negative numbers
    at = lambda p: F.kll_sketch_get_quantile_bigint("sketch", F.lit(p))
    return grouped.select(
        *by, "rows", (round_half_up_ratio(F.col("total") - low * F.col("rows"), F.col("rows"), 0, "bigint") + low).alias("avg_latency"),
        at(0.95).alias("p95_latency"), at(0.99).alias("p99_latency"), "least", "most")


class LatencyLog:
    """Latency sketches of a stream's micro-batches at ``path``, one row a batch (a replay replaces it)."""

    def __init__(self, path: str, event_time: str, write_time: str = "created_at"):
        self.path, self.event_time, self.write_time = path, event_time, write_time

    def save(self, stored: DataFrame, batch_id: int) -> None:
        (latency_sketches(stored, self.event_time, self.write_time, {"batch_id": F.lit(batch_id).cast("bigint")})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(self.path))

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def processing_latency(rows: DataFrame, event_time: str, write_time: str, unit_ms: int = 1) -> DataFrame:
    """Write time less event time over stored rows: rows, average (rounded
    half up to whole units), P95 and P99 (values that occur) in units of ``unit_ms``.

    Rows without either time are left out.
    """
    from tillstream.functions.money import round_half_up_ratio
    each = rows.select(_latency(event_time, write_time, unit_ms).alias("latency"))
    # Spark's exact percentiles keep counts per distinct value, combined map-side.
    at = lambda p: F.expr(f"CAST(percentile_disc({p}) WITHIN GROUP (ORDER BY latency) AS BIGINT)")
    n = F.count("latency")
    low = F.least(F.min("latency"), F.lit(0))  # the exact rounding is for non-negative numbers
    return each.agg(
        n.alias("rows"),
        (round_half_up_ratio(F.sum("latency") - low * n, n, 0, "bigint") + low).alias("avg_latency"),
        at(0.95).alias("p95_latency"), at(0.99).alias("p99_latency"))
