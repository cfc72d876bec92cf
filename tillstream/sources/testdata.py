"""Mappings from the test tables to the transaction model.

``events``  -> transactions without items:
    event_id -> transaction_id, ts -> event_time, event_type -> store_id,
    user_id -> customer_id, value -> final_amount (= total_amount).

star schema -> transactions with items:
    o_orderkey -> transaction_id,
    o_orderdate + (o_orderkey % 1440) minutes -> event_time,
    nation name of the customer -> store_id, c_custkey / c_mktsegment ->
    customer_id / customer_type, o_orderpriority -> payment_method,
    line items -> items (p_partkey / p_name / p_type, l_quantity as INT,
    l_extendedprice as total, l_extendedprice / l_quantity as unit price),
    total_amount = sum(l_extendedprice), discount_applied =
    sum(l_extendedprice * l_discount), final_amount = total - discount.

Every reader takes an optional event-time range and turns it into a predicate
on the *raw* scan column, so Parquet row-group statistics prune the scan
(``PushedFilters``) before any join or window expansion.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillstream.functions.money import MONEY
from tillstream.functions.timebounds import TimeRange

MINUTES_PER_DAY = 1440


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(t: dt.datetime) -> Column:
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def _raw_range(c: Column, rng: TimeRange | None) -> Column:
    cond = F.lit(True)
    if rng is not None and rng.start is not None:
        cond = cond & (c >= _ntz(rng.start))
    if rng is not None and rng.end is not None:
        cond = cond & (c < _ntz(rng.end))
    return cond


# --- events -> transactions without items ---------------------------------

def event_transactions(spark: SparkSession, sf_dir: str, rng: TimeRange | None = None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    if rng is not None:
        ev = ev.where(_raw_range(F.col("ts"), rng))
    return ev.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_type").alias("store_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("value").alias("total_amount"),
        F.col("value").alias("final_amount"),
    )


def event_time_between(start: dt.datetime, end: dt.datetime) -> Column:
    """Condition on the raw event time."""
    return _raw_range(F.col("ts"), TimeRange(start, end))


def event_messages(spark: SparkSession, sf_dir: str, rng: TimeRange | None = None,
                   bad: bool = False, where: Column | None = None, days_later: int = 0,
                   items: bool = False) -> DataFrame:
    """The events (of ``rng``) as retail-transactions topic messages (``key``, ``value``).

    ``bad``: every 97th id has an unreadable timestamp, every 89th no store.
    ``days_later``: the time in the message is that much later than the event's.
    ``items``: each message has one item, its product and quantity from the ids.
    """
    ev = table(spark, sf_dir, "events")
    if rng is not None:
        ev = ev.where(_raw_range(F.col("ts"), rng))
    if where is not None:
        ev = ev.where(where)
    told = F.timestamp_add("DAY", F.lit(days_later), F.col("ts")) if days_later else F.col("ts")
    time, store = F.date_format(told, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.col("event_type")
    if bad:
        time = F.when(F.col("event_id") % 97 == 0, F.lit("nope")).otherwise(time)
        store = F.when(F.col("event_id") % 89 != 0, store)
    product = F.pmod("user_id", F.lit(50))
    item = F.struct(F.concat(F.lit("p"), product).alias("product_id"), F.concat(F.lit("product "), product).alias("product_name"),
                    F.lit("all").alias("category"), (F.pmod("event_id", F.lit(4)) + 1).cast("int").alias("quantity"),
                    F.col("value").alias("total"))
    payload = F.struct(
        F.col("event_id").cast("string").alias("transaction_id"),
        time.alias("timestamp"),
        store.alias("store_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        *([F.array(item).alias("items")] if items else []),
        F.col("value").alias("total_amount"),
        F.col("value").alias("final_amount"),
    )
    return ev.select(F.col("event_id").cast("string").alias("key"),
                     F.to_json(payload).alias("value"))


def customer_messages(spark: SparkSession, sf_dir: str, rng: TimeRange | None = None) -> DataFrame:
    """The events as customer-events topic messages: user_id -> customer_id, page_views and
    session_duration from the id."""
    ev = table(spark, sf_dir, "events")
    if rng is not None:
        ev = ev.where(_raw_range(F.col("ts"), rng))
    payload = F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type"),
        F.concat(F.lit("s"), F.pmod("event_id", F.lit(10))).alias("store_id"),
        F.pmod("event_id", F.lit(600)).cast("int").alias("session_duration"),
        F.pmod("event_id", F.lit(5)).cast("int").alias("page_views"),
    )
    return ev.select(F.col("event_id").cast("string").alias("key"), F.to_json(payload).alias("value"))


def inventory_messages(spark: SparkSession, sf_dir: str, again: Column | None = None,
                       unordered: int | None = None) -> DataFrame:
    """Line items as inventory-updates topic messages: l_suppkey % 20 -> store_id, l_partkey -> product_id,
    shipping date plus line number in hours -> timestamp, the quantity sold leaves the stock.

    ``again``: the messages of these lines come twice. ``unordered``: the messages are dealt to so many
    partitions; what is dealt is the lines' few columns, not the text made of them.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    if again is not None:
        lines = lines.unionByName(lines.where(again))
    if unordered:
        lines = lines.repartition(unordered)
    payload = F.struct(
        F.format_string("%d-%d", "l_orderkey", "l_linenumber").alias("event_id"),
        F.date_format(F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("l_shipdate")), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.pmod("l_suppkey", F.lit(20)).cast("string").alias("store_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.lit("sale").alias("event_type"),
        (-F.col("l_quantity")).cast("int").alias("quantity_change"),
        F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(500)).cast("int").alias("current_stock"),
        F.pmod("l_partkey", F.lit(100)).cast("int").alias("reorder_level"),
    )
    return lines.select(F.col("l_orderkey").cast("string").alias("key"), F.to_json(payload).alias("value"))


# --- star schema -> transactions with items --------------------------------

def _order_time(orderkey: Column, orderdate: Column) -> Column:
    return F.timestamp_add("MINUTE", (orderkey % MINUTES_PER_DAY).cast("int"), orderdate)


def _orders(spark: SparkSession, sf_dir: str, rng: TimeRange | None) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    if rng is not None:
        # event_time lies in [o_orderdate, o_orderdate + 1 day): a pushable
        # bound on the raw date column, then the exact bound on event_time.
        orders = orders.where(_raw_range(F.col("o_orderdate"), rng.widen(before=dt.timedelta(days=1))))
    orders = orders.withColumn("event_time_ntz", _order_time(F.col("o_orderkey"), F.col("o_orderdate")))
    if rng is not None:
        orders = orders.where(_raw_range(F.col("event_time_ntz"), rng))
    return orders


def star_item_rows(spark: SparkSession, sf_dir: str, rng: TimeRange | None = None,
                   with_product: bool = True) -> DataFrame:
    """One row per line item: ``event_time, transaction_id, product_id,
    quantity, unit_price, revenue`` (+ ``product_name, category``).

    Equal to exploding the items of the star-mapped transactions, built by
    joins only (no per-order collection of lines).
    """
    orders = _orders(spark, sf_dir, rng).select(
        "o_orderkey", F.col("event_time_ntz").cast("timestamp").alias("event_time"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    items = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner").select(
        "event_time",
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.round(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")), 2).alias("unit_price"),
        F.col("l_extendedprice").alias("revenue"),
    )
    if with_product:
        items = items.join(products(spark, sf_dir), "product_id", "inner")
    return items


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension: ``product_id, product_name, category``.

    ``product_id`` stays the numeric part key through joins and aggregation
    (cheaper to hash and compare than text); ``product_key_as_id`` turns it
    into the message model's string id at the output.
    """
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"))


def product_key_as_id(df: DataFrame) -> DataFrame:
    return df.withColumn("product_id", F.col("product_id").cast("string"))


def item_messages(spark: SparkSession, sf_dir: str, in_order: int | None = None) -> DataFrame:
    """Each order as one transaction message with all its line items (an order
    has a handful of lines, so its array is small).

    ``in_order``: so many partitions, each later in event time than the one before it.
    The lines are dealt by that range once, which also brings an order's lines together.
    """
    items = product_key_as_id(star_item_rows(spark, sf_dir))
    if in_order:
        items = items.repartitionByRange(in_order, "event_time", "transaction_id")
    item = F.struct("product_id", "product_name", "category", "quantity",
                    "unit_price", F.col("revenue").alias("total"))
    orders = items.groupBy("transaction_id", "event_time").agg(
        F.collect_list(item).alias("items"),
        F.sum(F.col("revenue").cast(MONEY)).cast("double").alias("revenue"))
    payload = F.struct(
        "transaction_id",
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.lit("star").alias("store_id"),
        F.col("transaction_id").alias("customer_id"),
        "items",
        F.col("revenue").alias("total_amount"),
        F.col("revenue").alias("final_amount"),
    )
    return orders.select(F.col("transaction_id").alias("key"), F.to_json(payload).alias("value"))


def star_transactions(spark: SparkSession, sf_dir: str, rng: TimeRange | None = None) -> DataFrame:
    """Scalar transaction fields of the star mapping (items dropped), one row
    per transaction id.

    Orders are de-duplicated on the order key while the rows are narrowest;
    that shuffle is on the same key the join with the per-order line totals
    needs, so the de-duplication adds no exchange of its own at scale.
    """
    orders = _orders(spark, sf_dir, rng).select(
        "o_orderkey", "o_custkey", "o_orderpriority", "event_time_ntz").dropDuplicates(["o_orderkey"])
    line_money = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_extendedprice").cast(MONEY).alias("ext"),
        (F.col("l_extendedprice").cast(MONEY) * F.col("l_discount").cast("decimal(4,2)")).alias("disc"))
    # Partial aggregation happens before the shuffle on l_orderkey, so an order
    # with a huge number of lines is reduced map-side.
    totals = line_money.groupBy("l_orderkey").agg(
        F.sum("ext").alias("total_amount"), F.sum("disc").alias("discount_applied"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    tx = (orders
          .join(totals, orders.o_orderkey == totals.l_orderkey, "left")
          .join(customers, orders.o_custkey == customers.c_custkey, "inner")
          .join(nations, customers.c_nationkey == nations.n_nationkey, "inner"))
    total = F.coalesce(F.col("total_amount"), F.lit(0))
    discount = F.coalesce(F.col("discount_applied"), F.lit(0))
    return tx.select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("event_time_ntz").cast("timestamp").alias("event_time"),
        F.col("n_name").alias("store_id"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_mktsegment").alias("customer_type"),
        total.alias("total_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        discount.alias("discount_applied"),
        (total - discount).alias("final_amount"),
    )
