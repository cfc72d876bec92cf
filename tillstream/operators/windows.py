"""Event-time window aggregations (Q1, Q2, Q3, Q16).

Each function maps a transactions DataFrame (batch or streaming) to a window
summary. On a stream the watermark bounds the state and append mode emits a
window once, when the watermark passes its end; on a batch the watermark is
ignored and every window is produced.

Physical shape: partial aggregation per input partition (map-side combine),
one hash shuffle on (window, key), final aggregation. A hot store only adds
partial rows per partition, never a single huge group. Sliding windows with exact
distinct counts shuffle each event once (to its block of panes) and then only
sums; approximate ones expand each row into length/slide copies first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.functions.money import MEAN, MONEY, exact_mean, money_sum

DEFAULT_WATERMARK = "1 minute"


def _with_watermark(df: DataFrame, watermark: str | None) -> DataFrame:
    return df.withWatermark("event_time", watermark) if watermark else df


def _micros(span: str) -> int:
    """Length of an interval such as ``30 seconds`` in microseconds."""
    number, unit = span.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1_000_000


#: Panes in a block of ``pane_window_summary``; an event is sent to a second block once in so many panes.
BLOCK_PANES = 20


def pane_window_summary(tx: DataFrame, window: str = "1 minute", slide: str = "30 seconds",
                        watermark: str | None = DEFAULT_WATERMARK) -> DataFrame:
    """Q1 from disjoint panes: each event is aggregated once, in the pane of one
    slide that holds it, and panes are combined into the windows they lie in.

    On a table, rows are dealt once by (block of panes, store, customer), so all
    panes of a customer that a window needs are in one task: one row per (pane,
    store, customer), then per (window, store, customer), and only sums and counts
    per (window, store) leave it. A pane at a block's edge also goes to the block
    before. The block keeps a frequent customer (or the missing one) from being
    one task's. On a stream, panes per (pane, store) carry a customer sketch and a
    second windowed aggregation merges them (``window_time``), so state holds
    sketches and an event updates one of them.
    """
    slots, rest = divmod(_micros(window), _micros(slide))
    if rest:
        raise ValueError(f"windows of {window} are not made of whole panes of {slide}")
    return (_stream_panes if tx.isStreaming else _table_panes)(tx, window, slide, slots, watermark)


def _sums() -> tuple[Column, ...]:
    return F.sum("n").alias("n"), F.sum("amount").alias("amount"), F.sum("amounts").alias("amounts")


def _summary_columns(agg: DataFrame, customers: Column) -> DataFrame:
    return agg.select(
        "window_start", "window_end", "store_id", F.col("n").alias("total_transactions"),
        F.col("amount").cast(MONEY).alias("total_revenue"),
        (F.col("amount") / F.when(F.col("amounts") > 0, F.col("amounts"))).cast(MEAN).alias("avg_transaction_value"),
        customers.cast("bigint").alias("unique_customers"))


def _table_panes(tx: DataFrame, window: str, slide: str, slots: int, watermark: str | None) -> DataFrame:
    step = _micros(slide)
    reach = max(BLOCK_PANES, slots)
    blocks = F.array_distinct(F.array(F.floor(F.col("pane") / reach), F.floor((F.col("pane") - (slots - 1)) / reach)))
    dealt = (tx.where(F.col("event_time").isNotNull())
             .select(F.unix_micros("event_time").alias("t"), "store_id", "customer_id",
                     F.col("transaction_id").isNotNull().cast("bigint").alias("one"), F.col("final_amount").cast(MONEY).alias("money"))
             .withColumn("pane", F.expr(f"t div {step} - if(t % {step} < 0, 1, 0)"))
             .select("*", F.explode(blocks).alias("block"))
             .repartition("block", "store_id", "customer_id"))
    panes = dealt.groupBy("block", "store_id", "customer_id", "pane").agg(
        F.sum("one").alias("n"), F.sum("money").alias("amount"), F.count("money").alias("amounts"))
    starts = F.filter(F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), lambda k: F.col("pane") - k),
                      lambda w: F.floor(w / reach) == F.col("block"))
    customers = (panes.withColumn("start", F.explode(starts))
                 .groupBy("block", "store_id", "customer_id", "start").agg(*_sums()))
    agg = (customers.groupBy("block", "store_id", "start").agg(*_sums(), F.count("customer_id").alias("customers"))
           .withColumn("window_start", F.timestamp_micros(F.col("start") * step))
           .withColumn("window_end", F.timestamp_micros(F.col("start") * step + _micros(window))))
    return _summary_columns(agg, F.col("customers"))


def _stream_panes(tx: DataFrame, window: str, slide: str, slots: int, watermark: str | None) -> DataFrame:
    panes = (_with_watermark(tx, watermark).groupBy(F.window("event_time", slide).alias("pane"), "store_id").agg(
        F.count("transaction_id").alias("n"), F.sum(F.col("final_amount").cast(MONEY)).alias("amount"),
        F.count(F.col("final_amount").cast(MONEY)).alias("amounts"),
        F.hll_sketch_agg("customer_id", SKETCH_LG_K).alias("sketch")))
    agg = (panes.withColumn("at", F.window_time("pane")).groupBy(F.window("at", window, slide).alias("window"), "store_id")
           .agg(*_sums(), F.hll_union_agg("sketch").alias("sketch"))
           .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "store_id",
                   "n", "amount", "amounts", "sketch"))
    return _summary_columns(agg, F.hll_sketch_estimate("sketch"))


SKETCH_LG_K = 12  # HLL sketch size 2^12 registers (about 1.6 % standard error)


def distinct_count(c: str, mode: str | None, streaming: bool) -> Column:
    """Distinct count of ``c`` in a group: ``exact`` (``count(distinct)``, the
    default on tables) or ``approx`` (``approx_count_distinct``, HyperLogLog++
    with 5 % default error; the default on streams, where a distinct count is
    not allowed). Both aggregate in whole-stage codegen."""
    mode = mode or ("approx" if streaming else "exact")
    return F.approx_count_distinct(F.col(c)) if mode == "approx" else F.count_distinct(F.col(c))


def store_window_summary(tx: DataFrame, window: str = "1 minute", slide: str | None = "30 seconds",
                         watermark: str | None = DEFAULT_WATERMARK,
                         distinct: str | None = None) -> DataFrame:
    """Q1: per (sliding) window x store -> the ``transactions_summary`` row.

    Sliding windows of a table, with exact distinct counts, are combined from
    panes (``pane_window_summary``).
    """
    if slide and not tx.isStreaming and distinct != "approx" and _micros(window) % _micros(slide) == 0:
        return pane_window_summary(tx, window, slide, watermark)
    df = _with_watermark(tx, watermark)
    win = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    agg = df.groupBy(win.alias("window"), F.col("store_id")).agg(
        F.count("transaction_id").alias("total_transactions"),
        money_sum("final_amount", MONEY).alias("total_revenue"),
        exact_mean("final_amount", MEAN).alias("avg_transaction_value"),
        distinct_count("customer_id", distinct, tx.isStreaming).alias("unique_customers"),
    )
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "store_id", "total_transactions", "total_revenue",
        "avg_transaction_value", "unique_customers")


def store_tumbling_summary(tx: DataFrame, window: str = "1 minute",
                           watermark: str | None = DEFAULT_WATERMARK,
                           distinct: str | None = None, sketch: bool = False) -> DataFrame:
    """Q16: tumbling window x store, count / sum / distinct customers.

    Each transaction lands in exactly one window, so sums over these rows are
    true totals (unlike the sliding Q1, which counts every row twice). With
    ``sketch=True`` each row also keeps a mergeable HLL sketch of its
    customers (``customer_sketch``), so distinct customers over any set of
    windows is a sketch union (``rollups.distinct_customers``), not a sum.
    """
    df = _with_watermark(tx, watermark)
    measures = [
        F.count("transaction_id").alias("total_transactions"),
        money_sum("final_amount", MONEY).alias("total_revenue"),
        distinct_count("customer_id", distinct, tx.isStreaming).alias("unique_customers"),
    ]
    if sketch:
        measures.append(F.hll_sketch_agg("customer_id", SKETCH_LG_K).alias("customer_sketch"))
    agg = df.groupBy(F.window("event_time", window).alias("window"), F.col("store_id")).agg(*measures)
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "store_id", "total_transactions", "total_revenue", "unique_customers",
        *(["customer_sketch"] if sketch else []))


def explode_items(tx: DataFrame) -> DataFrame:
    """One row per item; transactions with NULL or empty items vanish."""
    return tx.select("event_time", F.explode("items").alias("item")).select(
        "event_time",
        F.col("item.product_id").alias("product_id"),
        F.col("item.product_name").alias("product_name"),
        F.col("item.category").alias("category"),
        F.col("item.quantity").alias("quantity"),
        F.col("item.total").alias("revenue"),
    )


def product_window_performance(items: DataFrame, window: str = "5 minutes",
                               watermark: str | None = DEFAULT_WATERMARK,
                               products: DataFrame | None = None) -> DataFrame:
    """Q2: per tumbling window x product -> ``product_performance`` rows.

    ``items`` are exploded item rows (``explode_items``). When the rows carry
    only ``product_id`` and a product dimension keyed by ``product_id`` is
    given, the aggregation runs first and the dimension is joined to the
    (much smaller) aggregate: name and category depend on the id alone, so the
    groups are the same.
    """
    df = _with_watermark(items, watermark)
    win = F.window("event_time", window).alias("window")
    measures = (F.sum("quantity").cast("bigint").alias("quantity_sold"),
                money_sum("revenue", "decimal(10,2)").alias("revenue"))
    if products is not None and "product_name" not in items.columns:
        agg = df.groupBy(win, "product_id").agg(*measures)
        agg = agg.join(products, "product_id", "inner")
    else:
        agg = df.groupBy(win, "product_id", "product_name", "category").agg(*measures)
    return agg.select(
        F.col("window.start").alias("window_start"),
        "product_id", "product_name", "category", "quantity_sold", "revenue")


def realtime_window_metrics(tx: DataFrame, window: str = "30 seconds",
                            watermark: str | None = DEFAULT_WATERMARK) -> DataFrame:
    """Q3: per tumbling window, no other key (global stream metrics)."""
    df = _with_watermark(tx, watermark)
    return df.groupBy(F.window("event_time", window).alias("window")).agg(
        F.count("transaction_id").alias("transactions_per_window"),
        money_sum("final_amount", MONEY).alias("revenue_per_window"),
        exact_mean("final_amount", MEAN).alias("avg_transaction_value"),
    )


def flatten_window(df: DataFrame) -> DataFrame:
    """``window`` struct -> ``window_start, window_end`` columns."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), *rest)
