"""Roll-ups over stored window summaries.

Inputs are ``transactions_summary`` / ``product_performance`` shaped
DataFrames (a Parquet scan, or a summary computed on the fly). Every trailing
query takes a ``TimeRange`` on ``window_start``; with a date-partitioned
table the scan prunes to the touched days (``sources.tables``).

The roll-ups keep the reference's definitions, including the two it gets
wrong on purpose of compatibility: sums over sliding windows count every
transaction twice, and ``avg_transaction_value`` is an unweighted mean of
per-window means. ``operators.insight.summary_exact`` gives the true values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.functions.money import TOTAL, mean_of_means, round_half_up_ratio
from tillstream.functions.timebounds import TimeRange, in_range



def _in(df: DataFrame, rng: TimeRange | None, col: str = "window_start") -> DataFrame:
    return df if rng is None else df.where(in_range(col, rng))


def _store(df: DataFrame, store: str | None) -> DataFrame:
    return df if store is None else df.where(F.col("store_id") == F.lit(store))


def summary_totals(summary: DataFrame, rng: TimeRange | None = None,
                   store: str | None = None) -> DataFrame:
    """Q4: one row, zeros when the range is empty (``COALESCE(agg, 0)``)."""
    s = _store(_in(summary, rng), store)
    return s.agg(
        F.coalesce(F.sum("total_transactions"), F.lit(0)).cast("bigint").alias("total_transactions"),
        F.coalesce(F.sum("total_revenue").cast(TOTAL), F.lit(0).cast(TOTAL)).alias("total_revenue"),
        F.coalesce(mean_of_means("avg_transaction_value"),
                   F.lit(0).cast("decimal(14,6)")).alias("avg_transaction_value"),
        F.coalesce(F.sum("unique_customers"), F.lit(0)).cast("bigint").alias("total_customers"),
    )


def top_stores(summary: DataFrame, rng: TimeRange | None = None, k: int = 10,
               store: str | None = None) -> DataFrame:
    """Q5: stores by revenue. NULL revenue sorts first (as PostgreSQL does on
    DESC); the store id breaks ties so the top-k is deterministic."""
    s = _store(_in(summary, rng), store)
    agg = s.groupBy("store_id").agg(
        F.sum("total_transactions").cast("bigint").alias("transactions"),
        F.sum("total_revenue").cast(TOTAL).alias("revenue"),
        mean_of_means("avg_transaction_value").alias("avg_transaction"),
    )
    return agg.orderBy(F.col("revenue").desc_nulls_first(), F.col("store_id").asc()).limit(k)


def top_products(products: DataFrame, rng: TimeRange | None = None, k: int = 10) -> DataFrame:
    """Q6: products by revenue, grouped by *name and category* (not by id)."""
    agg = _in(products, rng).groupBy("product_name", "category").agg(
        F.sum("quantity_sold").cast("bigint").alias("quantity"),
        F.sum("revenue").cast(TOTAL).alias("revenue"),
    )
    return agg.orderBy(F.col("revenue").desc_nulls_first(),
                       F.col("product_name").asc_nulls_first(),
                       F.col("category").asc_nulls_first()).limit(k)


def recent_activity(summary: DataFrame, rng: TimeRange) -> DataFrame:
    """Q7: number of summary rows (window x store) in the range."""
    return _in(summary, rng).agg(F.count(F.lit(1)).alias("recent_count"))


def data_flow(summary: DataFrame, rng: TimeRange) -> DataFrame:
    """Q8: is any summary row in the range? Stops at the first row found."""
    return (_in(summary, rng).select(F.lit(1).alias("one")).limit(1)
            .agg((F.count(F.lit(1)) > 0).alias("data_flow")))


def stream_stats(summary: DataFrame, rng: TimeRange | None = None) -> DataFrame:
    """Q9: distinct windows, first and last window, distinct stores."""
    return _in(summary, rng).agg(
        F.count_distinct("window_start").alias("windows_processed"),
        F.min("window_start").alias("earliest_window"),
        F.max("window_start").alias("latest_window"),
        F.count_distinct("store_id").alias("active_stores"),
    )


def export_transactions(summary: DataFrame, rng: TimeRange | None = None) -> DataFrame:
    """Q10: all summary columns, newest window first."""
    return _in(summary, rng).orderBy(F.col("window_start").desc(), F.col("store_id"))


def export_products(products: DataFrame, rng: TimeRange | None = None) -> DataFrame:
    """Q11: all product columns, highest revenue first."""
    return _in(products, rng).orderBy(F.col("revenue").desc_nulls_first(),
                                      F.col("window_start"), F.col("product_id"))


def total_metrics(summary: DataFrame) -> DataFrame:
    """Q12: all-time totals and number of stores."""
    return summary.agg(
        F.sum("total_transactions").cast("bigint").alias("sum_total_transactions"),
        F.sum("total_revenue").cast(TOTAL).alias("sum_total_revenue"),
        F.count_distinct("store_id").alias("distinct_stores"),
    )


def recent_windows(summary: DataFrame, k: int = 10) -> DataFrame:
    """Q13: the newest ``k`` summary rows (store id breaks ties)."""
    return (summary.select("window_start", "store_id", "total_transactions", "total_revenue")
            .orderBy(F.col("window_start").desc(), F.col("store_id").asc()).limit(k))


def system_stats(summary: DataFrame) -> DataFrame:
    """Q14: rows, transactions, revenue, stores, newest window; all time."""
    return summary.agg(
        F.count(F.lit(1)).alias("windows_processed"),
        F.sum("total_transactions").cast("bigint").alias("all_transactions"),
        F.sum("total_revenue").cast(TOTAL).alias("total_revenue"),
        F.count_distinct("store_id").alias("active_stores"),
        F.max("window_start").alias("latest_window"),
    )


def summary_row_count(summary: DataFrame) -> DataFrame:
    """Q15: ``COUNT(*)``."""
    return summary.agg(F.count(F.lit(1)).alias("row_count"))


# --- dashboard figures derived from the roll-ups (U1-U7) -------------------

def dashboard_cards(summary: DataFrame, rng: TimeRange) -> DataFrame:
    """U1 transactions/minute = round(n / 60), U2 revenue/hour, U3 active
    customers, U5 events/second = round(n / 3600); rounding is half up."""
    totals = summary_totals(summary, rng)
    n = F.col("total_transactions")
    return totals.select(
        round_half_up_ratio(n, F.lit(60), 0, "bigint").alias("transactions_per_minute"),
        F.col("total_revenue").alias("revenue_per_hour"),
        F.col("total_customers").alias("active_customers"),
        round_half_up_ratio(n, F.lit(3600), 0, "bigint").alias("events_per_second"),
    )


def active_categories(products: DataFrame, rng: TimeRange | None = None, k: int = 10) -> DataFrame:
    """Distinct categories among the top-k products."""
    return top_products(products, rng, k).agg(
        F.count_distinct("category").alias("active_categories"))


def revenue_by_store(summary: DataFrame, rng: TimeRange | None = None, k: int = 10) -> DataFrame:
    """Store -> revenue series of the top stores."""
    return top_stores(summary, rng, k).select("store_id", "revenue")


def hourly_change(summary: DataFrame, rng: TimeRange | None = None) -> DataFrame:
    """U4: change of the trailing-hour totals against the hour before.

    The trailing hour at each full hour ``h`` is the set of windows starting in
    ``[h - 1h, h)``. Hours are summed once; each then stands for itself and, an
    hour later, as the predecessor, and one more aggregate brings the two
    together (one scan, no join, no global ordering window). The change is
    ``|cur - prev| / prev * 100`` rounded half up to one decimal, NULL when
    the previous hour is empty.
    """
    s = _in(summary, rng)
    hourly = s.groupBy(F.date_trunc("hour", "window_start").alias("hour_start")).agg(
        F.sum("total_transactions").cast("bigint").alias("transactions"),
        F.sum("total_revenue").cast(TOTAL).alias("revenue"))
    roles = hourly.select("transactions", "revenue", F.inline(F.array(
        F.struct(F.col("hour_start"), F.lit(True).alias("own")),
        F.struct((F.col("hour_start") + F.expr("INTERVAL 1 HOUR")).alias("hour_start"), F.lit(False).alias("own")))))
    one = lambda c, own: F.max(F.when(F.col("own") == own, F.col(c)))
    joined = roles.groupBy("hour_start").agg(
        one("transactions", True).alias("transactions"), one("revenue", True).alias("revenue"),
        one("transactions", False).alias("prev_transactions"), one("revenue", False).alias("prev_revenue"),
    ).where(F.col("transactions").isNotNull())
    cents = lambda c: (F.col(c) * 100).cast("bigint")
    return joined.select(
        "hour_start", "transactions", "revenue", "prev_transactions", "prev_revenue",
        round_half_up_ratio(F.abs(F.col("transactions") - F.col("prev_transactions")) * 100,
                            F.col("prev_transactions"), 1, "decimal(20,1)").alias("transactions_change_pct"),
        round_half_up_ratio(F.abs(cents("revenue") - cents("prev_revenue")) * 100,
                            cents("prev_revenue"), 1, "decimal(20,1)").alias("revenue_change_pct"),
    )


def distinct_customers(sketched: DataFrame, rng: TimeRange | None = None,
                       by: tuple[str, ...] = ("store_id",)) -> DataFrame:
    """X6 via sketches: distinct customers over the windows in ``rng`` as the
    estimate of the union of the stored per-window HLL sketches (a customer
    seen in many windows counts once). Partial unions run map-side, so only
    one sketch per key and task is shuffled."""
    s = _in(sketched, rng)
    return s.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("customer_sketch")).alias("distinct_customers"))
