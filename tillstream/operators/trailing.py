"""Trailing figures at every poll (U4), without a window per poll.

A dashboard asks every few seconds for the totals of the trailing hour and
compares them with its previous answer. A summary window counts at the polls p
with ``p - span <= window_start < p``: it enters at one poll and leaves at
another. Both are written down as a plus and a minus; the totals at every poll
are a running sum of these deltas, and the previous poll's totals are the
running sum without the poll's own delta.

The running sum has two levels: deltas are summed per poll and per block of
polls (map-side combined), the block totals are prefixed (one row a block), and
each block runs within itself, blocks in parallel. Polls without a change are
rows, too, made block by block.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.functions.money import TOTAL, round_half_up_ratio
from tillstream.functions.timebounds import TimeRange, ts_literal

#: Polls in a block (an hour of 5-second polls).
BLOCK_POLLS = 720


def _change(now: Column, before: Column, units: int = 1) -> Column:
    """|now - before| in percent of before, one decimal, exact; NULL where before is 0."""
    whole = lambda c: (c * units).cast("decimal(38,0)")
    return round_half_up_ratio(F.abs(whole(now) - whole(before)) * 100, whole(before), 1, "decimal(30,1)")


def polled_totals(summary: DataFrame, rng: TimeRange, every: dt.timedelta = dt.timedelta(seconds=5),
                  span: dt.timedelta = dt.timedelta(hours=1), block_polls: int = BLOCK_POLLS) -> DataFrame:
    """One row per poll of ``rng``: ``poll_time``, the trailing ``transactions`` and ``revenue``, those
    of the poll before (``prev_…``, NULL at the first), and their change in percent."""
    step = int(every.total_seconds() * 1_000_000)
    polls = -(-(rng.end - rng.start) // every)
    start = F.unix_micros(ts_literal(rng.start))
    # The first poll after a window's start, counted from the range's first.
    after = F.floor((F.col("t") - start) / step).cast("bigint") + 1
    rows = (summary.where((F.col("window_start") >= ts_literal(rng.start - span)) & (F.col("window_start") < ts_literal(rng.end)))
            .select(F.unix_micros("window_start").alias("w"), "total_transactions", F.col("total_revenue").cast(TOTAL).alias("total_revenue")))
    micros = int(span.total_seconds() * 1_000_000)
    deltas = rows.select(F.explode(F.array(
        F.struct(F.col("w").alias("t"), F.col("total_transactions").alias("n"), F.col("total_revenue").alias("r")),
        F.struct((F.col("w") + micros).alias("t"), (-F.col("total_transactions")).alias("n"),
                 (-F.col("total_revenue")).cast(TOTAL).alias("r")))).alias("d")).select("d.*")
    per_poll = (deltas.select(F.greatest(after, F.lit(0)).alias("poll"), "n", "r").where(F.col("poll") < polls)
                .groupBy("poll").agg(F.sum("n").alias("n"), F.sum("r").cast(TOTAL).alias("r")))
    block = F.floor(F.col("poll") / block_polls)
    spark = summary.sparkSession
    blocks = spark.range(-(-polls // block_polls)).withColumnRenamed("id", "block")
    per_block = per_poll.groupBy(block.alias("block")).agg(F.sum("n").alias("n"), F.sum("r").cast(TOTAL).alias("r"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    base = (blocks.join(per_block, "block", "left").select(
        "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("r").over(earlier), F.lit(0)).cast(TOTAL).alias("r0")))
    grid = (base.withColumn("poll", F.explode(F.sequence(
        F.col("block") * block_polls, F.least((F.col("block") + 1) * block_polls, F.lit(polls)) - 1))))
    so_far = Window.partitionBy("block").orderBy("poll").rowsBetween(Window.unboundedPreceding, 0)
    dense = (grid.join(per_poll, "poll", "left").select(
        "block", "poll", "n0", "r0", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("r", F.lit(0)).cast(TOTAL).alias("r"))
        .withColumn("transactions", F.col("n0") + F.sum("n").over(so_far))
        .withColumn("revenue", (F.col("r0") + F.sum("r").over(so_far)).cast(TOTAL)))
    asked = F.col("poll") > 0
    before_n, before_r = F.when(asked, F.col("transactions") - F.col("n")), F.when(asked, (F.col("revenue") - F.col("r")).cast(TOTAL))
    return dense.select(
        F.timestamp_micros(start + F.col("poll") * step).alias("poll_time"), "transactions", "revenue",
        before_n.alias("prev_transactions"), before_r.alias("prev_revenue")).select(
        "*", _change(F.col("transactions"), F.col("prev_transactions")).alias("transactions_change_pct"),
        _change(F.col("revenue"), F.col("prev_revenue"), 100).alias("revenue_change_pct"))
