"""Hierarchical pre-aggregates of the stored summary (Q12, Q14, Q15 over any range).

Totals are kept per store for every minute, hour, day and month. A range is
answered by the few coarse nodes that lie inside it plus finer ones at its
edges, so what is read depends on the range's edges and hardly on its length,
and never on the number of raw events.

A stream's writer adds nodes for each micro-batch (``RollupLog``): partial sums
in a partition of their own, which a replay replaces and readers add up.
``compact`` merges the partials of batches below b into a partition named -b;
readers take a span's newest such partition and only later batches, so they see
each batch once, whatever step a compaction has reached.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.functions.money import TOTAL
from tillstream.functions.timebounds import TimeRange, in_range, ts_literal

#: Levels from fine to coarse, and what one partition of a level spans.
LEVELS = {"minute": "day", "hour": "month", "day": "year", "month": None}

_SUMS = ("rows", "transactions", "revenue")


def nodes(summary: DataFrame) -> DataFrame:
    """(level, span, node_start, store_id, rows, transactions, revenue, latest): partial totals of summary rows.

    Rows are reduced to minutes first (map-side), the coarser levels are made
    from those, all in one pass.
    """
    base = summary.groupBy(F.date_trunc("minute", "window_start").alias("minute"), "store_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_transactions").alias("transactions"),
        F.sum(F.col("total_revenue").cast(TOTAL)).cast(TOTAL).alias("revenue"), F.max("window_start").alias("latest"))
    span = lambda of: F.lit("all") if of is None else F.date_format(F.date_trunc(of, "minute"), "yyyy-MM-dd")
    per_level = base.select("*", F.explode(F.array(*[
        F.struct(F.lit(level).alias("level"), span(of).alias("span"), F.date_trunc(level, "minute").alias("node_start"))
        for level, of in LEVELS.items()])).alias("at"))
    return _added(per_level.select("at.*", "store_id", *_SUMS, "latest"))


def _added(partials: DataFrame) -> DataFrame:
    return partials.groupBy("level", "span", "node_start", "store_id").agg(
        F.sum("rows").alias("rows"), F.sum("transactions").alias("transactions"),
        F.sum("revenue").cast(TOTAL).alias("revenue"), F.max("latest").alias("latest"))


class RollupLog:
    """Nodes stored below ``path``, partitioned by level, span and batch."""

    def __init__(self, path: str):
        self.path = path

    def add(self, summary: DataFrame, batch_id: int = 0) -> None:
        """Add the nodes of summary rows that no other batch holds (a replay replaces its own)."""
        self._write(nodes(summary).withColumn("batch_id", F.lit(batch_id).cast("bigint")))

    __call__ = add

    def _write(self, df: DataFrame) -> None:
        (df.repartition("level", "span").sortWithinPartitions("level", "span", "node_start", "store_id")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("level", "span", "batch_id").parquet(self.path))

    def _partials(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("node_start timestamp, store_id string, rows bigint, transactions bigint, "
                                 f"revenue {TOTAL}, latest timestamp, level string, span string, batch_id bigint").parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        """Partial nodes, every batch once."""
        stored = self._partials(spark)
        merged = (stored.where("batch_id < 0").groupBy(F.col("level").alias("l"), F.col("span").alias("s"))
                  .agg(F.min("batch_id").alias("merged")))
        found = stored.join(merged, (F.col("level") == F.col("l")) & (F.col("span") == F.col("s")), "left")
        below = -F.coalesce("merged", F.lit(0))
        return found.where((F.col("batch_id") == F.col("merged")) | (F.col("batch_id") >= below)).drop("l", "s", "merged")

    def compact(self, spark: SparkSession, before: int, staging: str) -> None:
        """Merge the partials of batches older than ``before``, none of which may be replayed any more."""
        from tillstream.sinks.parquet import _file_system
        if before < 1:
            return
        old = [tuple(r) for r in self._partials(spark).where((F.col("batch_id") < before) & (F.col("batch_id") > -before))
               .select("level", "span", "batch_id").distinct().collect()]
        if not old:
            return
        touched = F.concat_ws("/", "level", "span").isin(sorted({f"{level}/{span}" for level, span, _ in old}))
        _added(self.read(spark).where(touched & (F.col("batch_id") < before))).write.mode("overwrite").parquet(staging)
        self._write(spark.read.parquet(staging).withColumn("batch_id", F.lit(-before).cast("bigint")))
        for level, span, batch_id in old:
            place, files = _file_system(spark, f"{self.path}/level={level}/span={span}/batch_id={batch_id}")
            files.delete(place, True)


def _next(t: dt.datetime, level: str) -> dt.datetime:
    """The end of the node of ``level`` that starts at ``t``."""
    if level == "month":
        return (t + dt.timedelta(days=32)).replace(day=1)
    return t + {"minute": dt.timedelta(minutes=1), "hour": dt.timedelta(hours=1), "day": dt.timedelta(days=1)}[level]


def _down(t: dt.datetime, level: str) -> dt.datetime:
    zero = {"minute": {}, "hour": {"minute": 0}, "day": {"minute": 0, "hour": 0}, "month": {"minute": 0, "hour": 0, "day": 1}}[level]
    return t.replace(second=0, microsecond=0, **zero)


def _up(t: dt.datetime, level: str) -> dt.datetime:
    low = _down(t, level)
    return low if low == t else _next(low, level)


def cover(start: dt.datetime, end: dt.datetime) -> list[tuple[str, dt.datetime, dt.datetime]]:
    """(level, from, to) runs of nodes that tile ``[start, end)``, bounds on full minutes: at most two a level."""
    if _down(start, "minute") != start or _down(end, "minute") != end:
        raise ValueError("a range of pre-aggregates needs bounds on full minutes")
    out, levels = [], list(LEVELS)
    left, right = start, end
    for level, coarser in zip(levels, levels[1:]):
        inner_left, inner_right = _up(left, coarser), _down(right, coarser)
        if inner_left >= inner_right:  # no coarser node fits: the rest is this level's
            break
        out += [(level, left, inner_left), (level, inner_right, right)]
        left, right = inner_left, inner_right
    else:
        level = levels[-1]
    return [(x, a, b) for x, a, b in [*out, (level, left, right)] if a < b]


def nodes_of(stored: DataFrame, rng: TimeRange | None = None) -> DataFrame:
    """The nodes that tile ``rng`` (all time: the months)."""
    if rng is None:
        return stored.where(F.col("level") == "month")
    parts = []
    for level, a, b in cover(rng.start, rng.end):
        of = LEVELS[level]
        cond = (F.col("level") == level) & (F.col("node_start") >= ts_literal(a)) & (F.col("node_start") < ts_literal(b))
        if of is not None:  # span names sort like the dates they are
            zero = {"day": {}, "month": {"day": 1}, "year": {"day": 1, "month": 1}}[of]
            cond = cond & F.col("span").between(a.replace(**zero).strftime("%Y-%m-%d"), b.strftime("%Y-%m-%d"))
        parts.append(cond)
    wanted = F.lit(False)
    for cond in parts:
        wanted = wanted | cond
    return stored.where(wanted)


def totals(found: DataFrame) -> DataFrame:
    """Q12 / Q14 / Q15 figures of nodes: rows, transactions, revenue, stores, latest window."""
    return found.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("windows_processed"), F.sum("transactions").alias("all_transactions"),
        F.sum("revenue").cast(TOTAL).alias("total_revenue"), F.count_distinct("store_id").alias("active_stores"),
        F.max("latest").alias("latest_window"))


def totals_of_rows(summary: DataFrame, rng: TimeRange | None = None) -> DataFrame:
    """The same figures from the summary rows themselves."""
    rows = summary if rng is None else summary.where(in_range("window_start", rng))
    return totals(nodes(rows).where(F.col("level") == "minute"))
