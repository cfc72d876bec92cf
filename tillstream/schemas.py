"""Message schemas (S3-S5) and stored-table contracts (K5).

The nullable flags mirror the message producer's contract, but ``from_json``
does not enforce them: a missing required field parses to NULL. Validity is
therefore an explicit rule (``REQUIRED`` below, applied in
``sources.decode.validity``).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

ITEM = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("total", T.DoubleType()),
])

# S3: retail-transactions topic value.
TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("timestamp", T.StringType(), False),
    T.StructField("store_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("customer_type", T.StringType(), True),
    T.StructField("items", T.ArrayType(ITEM)),
    T.StructField("total_amount", T.DoubleType(), False),
    T.StructField("payment_method", T.StringType(), True),
    T.StructField("discount_applied", T.DoubleType(), True),
    T.StructField("final_amount", T.DoubleType(), False),
])

# Inventory-updates topic value.
INVENTORY = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("timestamp", T.StringType(), False),
    T.StructField("store_id", T.StringType(), False),
    T.StructField("product_id", T.StringType(), False),
    T.StructField("product_name", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("quantity_change", T.IntegerType()),
    T.StructField("current_stock", T.IntegerType()),
    T.StructField("reorder_level", T.IntegerType()),
    T.StructField("alert", T.BooleanType()),
])

# Customer-events topic value.
CUSTOMER_EVENT = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("timestamp", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("event_type", T.StringType()),
    T.StructField("store_id", T.StringType()),
    T.StructField("session_duration", T.IntegerType()),
    T.StructField("page_views", T.IntegerType()),
    T.StructField("device", T.StringType()),
    T.StructField("channel", T.StringType()),
])

# Fields whose absence makes a message invalid (non-nullable in the schema),
# plus a parseable event time.
REQUIRED = {
    "transactions": ("transaction_id", "timestamp", "store_id", "customer_id",
                     "total_amount", "final_amount"),
    "inventory": ("event_id", "timestamp", "store_id", "product_id"),
    "customer_events": ("event_id", "timestamp", "customer_id"),
}

MESSAGE_SCHEMAS = {
    "transactions": TRANSACTION,
    "inventory": INVENTORY,
    "customer_events": CUSTOMER_EVENT,
}


@dataclass(frozen=True)
class Column:
    name: str
    dtype: str                    # Spark SQL type name
    nullable: bool = True
    default: str | None = None    # SQL expression used when the value is NULL
    max_length: int | None = None  # VARCHAR(n)


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()
    # Span of one date partition: "day", or "month" for tables with little data a day.
    partition_unit: str = "day"
    # True when rows are produced under a wider group key than the table key,
    # so key uniqueness is not guaranteed by construction and is checked.
    check_unique: bool = False

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


# K5: stored tables. DECIMAL scales and VARCHAR lengths are fixed values of the
# stored-table definitions; ``created_at`` is stamped by the sink.
TRANSACTIONS_SUMMARY = TableContract(
    "transactions_summary",
    (
        Column("window_start", "timestamp", False),
        Column("window_end", "timestamp", False),
        Column("store_id", "string", False, max_length=50),
        Column("total_transactions", "bigint", default="0"),
        Column("total_revenue", "decimal(12,2)", default="0"),
        Column("avg_transaction_value", "decimal(10,2)", default="0"),
        Column("unique_customers", "bigint", default="0"),
        Column("created_at", "timestamp", default="current_timestamp()"),
    ),
    key=("window_start", "store_id"),
)

# The tumbling-window variant of the summary (no per-window mean).
TUMBLING_SUMMARY = TableContract(
    "tumbling_summary",
    tuple(c for c in TRANSACTIONS_SUMMARY.columns if c.name not in ("avg_transaction_value", "created_at"))
    + (Column("customer_sketch", "binary"),   # HLL sketch of the window's customers (optional)
       Column("created_at", "timestamp", default="current_timestamp()")),
    key=TRANSACTIONS_SUMMARY.key,
)

PRODUCT_PERFORMANCE = TableContract(
    "product_performance",
    (
        Column("window_start", "timestamp", False),
        Column("product_id", "string", False, max_length=20),
        Column("product_name", "string", max_length=100),
        Column("category", "string", max_length=50),
        Column("quantity_sold", "bigint", default="0"),
        Column("revenue", "decimal(10,2)", default="0"),
        Column("created_at", "timestamp", default="current_timestamp()"),
    ),
    key=("window_start", "product_id"),
    check_unique=True,  # grouped by (window, id, name, category), keyed by (window, id)
)

REALTIME_METRICS = TableContract(
    "realtime_metrics",
    (
        Column("metric_time", "timestamp", default="current_timestamp()"),
        Column("metric_name", "string", False, max_length=50),
        Column("metric_value", "decimal(10,2)", False),
        Column("dimension", "string", max_length=50),
        Column("created_at", "timestamp", default="current_timestamp()"),
    ),
    key=("metric_time", "metric_name", "dimension"),
)

TRANSACTIONS = TableContract(
    "transactions",
    (
        Column("transaction_id", "string", False, max_length=50),
        Column("timestamp", "timestamp", False),
        Column("store_id", "string", max_length=50),
        Column("customer_id", "string", max_length=50),
        Column("customer_type", "string", max_length=20),
        Column("total_amount", "decimal(10,2)"),
        Column("payment_method", "string", max_length=20),
        Column("discount_applied", "decimal(10,2)"),
        Column("final_amount", "decimal(10,2)"),
        Column("created_at", "timestamp", default="current_timestamp()"),
    ),
    key=("transaction_id",),
)

# What the streams over the customer and inventory topics keep.
CUSTOMER_SESSIONS = TableContract(
    "customer_sessions",
    (
        Column("customer_id", "string", False, max_length=50),
        Column("session_start", "timestamp", False),
        Column("session_end", "timestamp", False),
        Column("duration_us", "bigint", default="0"),
        Column("events", "bigint", default="0"),
        Column("page_views", "bigint", default="0"),
        Column("first_store", "string", max_length=50),
        Column("last_event_type", "string", max_length=50),
        Column("created_at", "timestamp", default="current_timestamp()"),
    ),
    key=("customer_id", "session_start"),
)

STOCK_LEVELS = TableContract(
    "stock_levels",
    (
        Column("store_id", "string", False, max_length=50),
        Column("product_id", "string", False, max_length=50),
        Column("updated_at", "timestamp", False),
        Column("event_id", "string", False, max_length=50),
        Column("product_name", "string", max_length=100),
        Column("event_type", "string", max_length=50),
        Column("current_stock", "int"),
        Column("reorder_level", "int"),
        Column("reorder", "boolean", default="false"),
        Column("created_at", "timestamp", default="current_timestamp()"),
    ),
    key=("store_id", "product_id"),
)

# The product table of sparse data: a month a partition instead of many tiny days.
SPARSE_PRODUCTS = replace(PRODUCT_PERFORMANCE, partition_unit="month")

CONTRACTS = {c.name: c for c in (TRANSACTIONS_SUMMARY, TUMBLING_SUMMARY, PRODUCT_PERFORMANCE,
                                 REALTIME_METRICS, TRANSACTIONS, CUSTOMER_SESSIONS, STOCK_LEVELS)}
