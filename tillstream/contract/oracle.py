"""DuckDB oracle SQL for the contract queries.

Written independently of the Spark plans: windows are bucket arithmetic
(``time_bucket``; a sliding 1 min / 30 s window is the bucket and the bucket
before it), exact means are integer half-up rounding of cent sums, and every
output is cast to the same plain types as ``queries.plain``.
"""

from __future__ import annotations

import datetime as dt

from tillstream.contract import params as P
from tillstream.contract.params import sql_ts


def mean_sql(x: str, scale: int = 2, dtype: str = "DECIMAL(10,2)") -> str:
    """Half-up mean of non-negative DECIMAL values at ``scale`` places."""
    f = 10 ** scale
    return (f"CAST(CAST((2 * CAST(SUM({x}) * {f} AS HUGEINT) + COUNT({x})) "
            f"// NULLIF(2 * COUNT({x}), 0) AS DECIMAL(38,0)) / {f}::DECIMAL(38,{scale}) AS {dtype})")


def ratio_sql(num: str, den: str, scale: int) -> str:
    """Half-up ``num / den`` at ``scale`` places for non-negative integers, as DOUBLE."""
    f = 10 ** scale
    units = f"((2 * ({num}) * {f} + ({den})) // (2 * ({den})))"
    return f"CASE WHEN ({den}) > 0 THEN CAST({units} AS DOUBLE) / {f} END"


def _in(col: str, start: dt.datetime | None, end: dt.datetime | None) -> str:
    conds = ["TRUE"]
    if start is not None:
        conds.append(f"{col} >= {sql_ts(start)}")
    if end is not None:
        conds.append(f"{col} < {sql_ts(end)}")
    return " AND ".join(conds)


def _hour(as_of=P.EVENTS_AS_OF, span=dt.timedelta(hours=1), col="window_start") -> str:
    return _in(col, as_of - span, as_of)


MONEY = "CAST({} AS DECIMAL(12,2))"

TX = """tx AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, ts AS event_time,
         event_type AS store_id, CAST(user_id AS VARCHAR) AS customer_id,
         CAST(value AS DECIMAL(12,2)) AS amount
  FROM events)"""

# Q1 over ``tx``: each event in the 30-s bucket that holds it and the one before.
SUMMARY = f"""{TX},
b AS (SELECT time_bucket(INTERVAL '30 seconds', event_time) AS b, * FROM tx),
w AS (SELECT b AS window_start, transaction_id, store_id, customer_id, amount FROM b
      UNION ALL
      SELECT b - INTERVAL '30 seconds', transaction_id, store_id, customer_id, amount FROM b),
summary AS (
  SELECT window_start, window_start + INTERVAL '1 minute' AS window_end, store_id,
         COUNT(transaction_id) AS total_transactions,
         CAST(SUM(amount) AS DECIMAL(12,2)) AS total_revenue,
         {mean_sql('amount')} AS avg_transaction_value,
         COUNT(DISTINCT customer_id) AS unique_customers
  FROM w GROUP BY window_start, store_id)"""

# The same over messages of which some have no readable time (dropped) or no store.
BAD_SUMMARY = SUMMARY.replace("event_type AS store_id", "CASE WHEN event_id % 89 <> 0 THEN event_type END AS store_id", 1) \
    .replace("FROM events)", "FROM events WHERE event_id % 97 <> 0)", 1)
BAD_CLOSED = "window_end <= (SELECT MAX(ts) FROM events WHERE event_id % 97 <> 0) - INTERVAL '1 minute'"

SUMMARY_COLS = """window_start, window_end, store_id, total_transactions,
  CAST(total_revenue AS DOUBLE) AS total_revenue,
  CAST(avg_transaction_value AS DOUBLE) AS avg_transaction_value, unique_customers"""

STAR_ITEMS = """o AS (
  SELECT o_orderkey, o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS event_time
  FROM orders),
items AS (
  SELECT o.event_time, CAST(l.l_partkey AS VARCHAR) AS product_id,
         CAST(l.l_quantity AS INTEGER) AS quantity, CAST(l.l_extendedprice AS DECIMAL(12,2)) AS revenue
  FROM lineitem l JOIN o ON l.l_orderkey = o.o_orderkey),
prod AS (SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category FROM part),
pp AS (
  SELECT time_bucket(INTERVAL '5 minutes', i.event_time) AS window_start, i.product_id,
         p.product_name, p.category,
         CAST(SUM(i.quantity) AS BIGINT) AS quantity_sold,
         CAST(SUM(i.revenue) AS DECIMAL(10,2)) AS revenue
  FROM items i JOIN prod p ON i.product_id = p.product_id
  GROUP BY 1, 2, 3, 4)"""

PP_COLS = "window_start, product_id, product_name, category, quantity_sold, CAST(revenue AS DOUBLE) AS revenue"

MEAN_OF_MEANS = mean_sql("avg_transaction_value", 6, "DECIMAL(14,6)")


def _totals(where: str) -> str:
    return f"""WITH {SUMMARY}
SELECT CAST(COALESCE(SUM(total_transactions), 0) AS BIGINT) AS total_transactions,
       CAST(COALESCE(SUM(total_revenue), 0) AS DOUBLE) AS total_revenue,
       CAST(COALESCE({MEAN_OF_MEANS}, 0) AS DOUBLE) AS avg_transaction_value,
       CAST(COALESCE(SUM(unique_customers), 0) AS BIGINT) AS total_customers
FROM summary WHERE {where}"""


def _cards(where: str | None = None, cols: str = """transactions_per_minute, revenue_per_hour, active_customers,
       events_per_second""") -> str:
    return f"""WITH {SUMMARY},
t AS (SELECT CAST(COALESCE(SUM(total_transactions), 0) AS BIGINT) AS n,
             CAST(COALESCE(SUM(total_revenue), 0) AS DOUBLE) AS revenue,
             CAST(COALESCE(SUM(unique_customers), 0) AS BIGINT) AS customers
      FROM summary WHERE {where or _hour()})
SELECT {cols} FROM (
  SELECT CAST((2 * n + 60) // 120 AS BIGINT) AS transactions_per_minute,
         revenue AS revenue_per_hour, customers AS active_customers,
         CAST((2 * n + 3600) // 7200 AS BIGINT) AS events_per_second
  FROM t)"""


def _top_stores() -> str:
    return f"""WITH {SUMMARY}
SELECT store_id, CAST(SUM(total_transactions) AS BIGINT) AS transactions,
       CAST(SUM(total_revenue) AS DOUBLE) AS revenue,
       CAST({MEAN_OF_MEANS} AS DOUBLE) AS avg_transaction
FROM summary WHERE {_hour()}
GROUP BY store_id ORDER BY SUM(total_revenue) DESC NULLS FIRST, store_id LIMIT 10"""


def _top_products() -> str:
    return f"""WITH {STAR_ITEMS}
SELECT product_name, category, CAST(SUM(quantity_sold) AS BIGINT) AS quantity,
       CAST(SUM(revenue) AS DOUBLE) AS revenue
FROM pp WHERE {_hour(P.STAR_AS_OF)}
GROUP BY product_name, category
ORDER BY SUM(revenue) DESC NULLS FIRST, product_name NULLS FIRST, category NULLS FIRST LIMIT 10"""


def _q3_rows() -> str:
    return f"""{TX},
m AS (
  SELECT time_bucket(INTERVAL '30 seconds', event_time) AS window_start,
         COUNT(transaction_id) AS transactions_per_window,
         CAST(SUM(amount) AS DECIMAL(12,2)) AS revenue_per_window,
         {mean_sql('amount')} AS avg_transaction_value
  FROM tx GROUP BY 1)"""


def _tumbling(name: str, where: str) -> str:
    return f"""{name} AS (
  SELECT time_bucket(INTERVAL '1 minute', event_time) AS window_start,
         time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' AS window_end,
         store_id, COUNT(transaction_id) AS total_transactions,
         CAST(SUM(amount) AS DECIMAL(12,2)) AS total_revenue,
         COUNT(DISTINCT customer_id) AS unique_customers
  FROM tx WHERE {where} GROUP BY 1, 2, 3)"""


TUMBLING_COLS = """window_start, window_end, store_id, total_transactions,
  CAST(total_revenue AS DOUBLE) AS total_revenue, unique_customers"""

MERGE_SIDES = (f"WITH {TX},\n" + _tumbling("existing", _in("event_time", None, P.MERGE_EXISTING_END)) + ",\n"
               + _tumbling("batch", _in("event_time", P.MERGE_BATCH_START, None)))

_day_names = ", ".join(f"'{d}'" for d in ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"])

CLOSED = "window_end <= (SELECT MAX(ts) FROM events) - INTERVAL '1 minute'"

ROLLUP = """SELECT COUNT(*) AS windows_processed, CAST(SUM(total_transactions) AS BIGINT) AS all_transactions,
       CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue, COUNT(DISTINCT store_id) AS active_stores,
       MAX(window_start) AS latest_window"""


def _polled() -> str:
    """Trailing totals at every poll by a range join of polls and windows."""
    n = int((P.POLL_END - P.POLL_START).total_seconds()) // P.POLL_SECONDS
    return f"""WITH {SUMMARY},
polls AS (SELECT i, {sql_ts(P.POLL_START)} + to_seconds(CAST(i * {P.POLL_SECONDS} AS BIGINT)) AS poll_time FROM range({n}) t(i)),
near AS (SELECT window_start, SUM(total_transactions) AS n, SUM(total_revenue) AS r FROM summary
         WHERE {_in('window_start', P.POLL_START - dt.timedelta(hours=1), P.POLL_END)} GROUP BY 1),
polled AS (SELECT i, poll_time, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS transactions,
              CAST(COALESCE(SUM(r), 0) AS DECIMAL(38,2)) AS revenue
       FROM polls LEFT JOIN near ON window_start >= poll_time - INTERVAL '1 hour' AND window_start < poll_time
       GROUP BY 1, 2),
steps AS (SELECT *, lag(transactions) OVER (ORDER BY i) AS pt, lag(revenue) OVER (ORDER BY i) AS pr FROM polled)
SELECT poll_time, transactions, CAST(revenue AS DOUBLE) AS revenue, pt AS prev_transactions,
       CAST(pr AS DOUBLE) AS prev_revenue,
       {ratio_sql('abs(transactions - pt) * 100', 'pt', 1)} AS transactions_change_pct,
       {ratio_sql('abs(CAST(revenue * 100 AS BIGINT) - CAST(pr * 100 AS BIGINT)) * 100', 'CAST(pr * 100 AS BIGINT)', 1)}
         AS revenue_change_pct
FROM steps"""


# Gaps and islands: a session starts where the customer's last event is more than a gap away.
SESSIONS = f"""e AS (SELECT CAST(user_id AS VARCHAR) AS customer_id, ts, event_id, event_type,
             's' || (event_id % 10) AS store, event_id % 5 AS views,
             CASE WHEN ts - lag(ts) OVER c <= INTERVAL '{P.SESSION_GAP_MINUTES} minutes' THEN 0 ELSE 1 END AS first
      FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL WINDOW c AS (PARTITION BY user_id ORDER BY ts)),
i AS (SELECT *, SUM(first) OVER (PARTITION BY customer_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM e),
sessions AS (
  SELECT customer_id, MIN(ts) AS session_start, MAX(ts) AS session_end,
         CAST(epoch_us(MAX(ts)) - epoch_us(MIN(ts)) AS BIGINT) AS duration_us, COUNT(*) AS events,
         CAST(SUM(views) AS BIGINT) AS page_views,
         first(store ORDER BY ts, CAST(event_id AS VARCHAR)) AS first_store,
         last(event_type ORDER BY ts, CAST(event_id AS VARCHAR)) AS last_event_type
  FROM i GROUP BY customer_id, island)"""

STOCK = """WITH m AS (
  SELECT CAST(l_suppkey % 20 AS VARCHAR) AS store_id, CAST(l_partkey AS VARCHAR) AS product_id,
         l_shipdate + to_hours(CAST(l_linenumber AS BIGINT)) AS updated_at,
         l_orderkey || '-' || l_linenumber AS event_id,
         CAST((l_orderkey * 7 + l_linenumber) % 500 AS INTEGER) AS current_stock,
         CAST(l_partkey % 100 AS INTEGER) AS reorder_level
  FROM lineitem),
k AS (SELECT *, row_number() OVER (PARTITION BY store_id, product_id
                                   ORDER BY updated_at DESC, event_id COLLATE "binary" DESC) AS k FROM m)
SELECT store_id, product_id, updated_at, event_id, current_stock, reorder_level, current_stock <= reorder_level AS reorder
FROM k WHERE k = 1"""

# What the events' messages, with an item each, leave in the streams' tables: closed windows only.
TABLE_FIGURES = f"""WITH {SUMMARY},
mark AS (SELECT MAX(ts) - INTERVAL '1 minute' AS t FROM events),
r AS (SELECT time_bucket(INTERVAL '30 seconds', event_time) AS b, COUNT(*) AS n FROM tx GROUP BY 1),
p AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS b, user_id % 50 AS product, SUM(event_id % 4 + 1) AS n
      FROM events GROUP BY 1, 2)
SELECT 'transactions_summary' AS table_name, COUNT(*) AS rows, CAST(SUM(total_transactions) AS BIGINT) AS total
FROM summary, mark WHERE window_end <= t
UNION ALL SELECT 'product_performance', COUNT(*), CAST(SUM(n) AS BIGINT) FROM p, mark WHERE b + INTERVAL '5 minutes' <= t
UNION ALL SELECT 'realtime_metrics', 3 * COUNT(*), CAST(SUM(n) AS BIGINT) FROM r, mark WHERE b + INTERVAL '30 seconds' <= t"""

ORACLE: dict[str, str] = {
    "store_window_summary": f"WITH {SUMMARY} SELECT {SUMMARY_COLS} FROM summary",

    "store_window_summary_exact": f"WITH {SUMMARY} SELECT {SUMMARY_COLS} FROM summary",

    "store_tumbling_summary": f"WITH {TX},\n{_tumbling('t', 'TRUE')} SELECT {TUMBLING_COLS} FROM t",

    "product_window_performance": f"WITH {STAR_ITEMS} SELECT {PP_COLS} FROM pp",

    "realtime_window_metrics": f"""WITH {_q3_rows()}
SELECT window_start, window_start + INTERVAL '30 seconds' AS window_end, transactions_per_window,
       CAST(revenue_per_window AS DOUBLE) AS revenue_per_window,
       CAST(avg_transaction_value AS DOUBLE) AS avg_transaction_value
FROM m""",

    "summary_last_hour": _totals(_hour()),

    "summary_empty_range": _totals(_hour(P.EMPTY_AS_OF)),

    "top_stores": _top_stores(),

    "top_products": _top_products(),

    "recent_activity": f"""WITH {SUMMARY}
SELECT COUNT(*) AS recent_count FROM summary WHERE {_hour(span=dt.timedelta(minutes=5))}""",

    "data_flow": f"""WITH {SUMMARY}
SELECT COUNT(*) > 0 AS data_flow FROM summary WHERE {_hour(span=dt.timedelta(minutes=5))}""",

    "stream_stats": f"""WITH {SUMMARY}
SELECT COUNT(DISTINCT window_start) AS windows_processed, MIN(window_start) AS earliest_window,
       MAX(window_start) AS latest_window, COUNT(DISTINCT store_id) AS active_stores
FROM summary WHERE {_hour()}""",

    "export_transactions": f"""WITH {SUMMARY}
SELECT {SUMMARY_COLS} FROM summary WHERE {_hour(span=dt.timedelta(hours=24))}
ORDER BY window_start DESC, store_id""",

    "export_products": f"""WITH {STAR_ITEMS}
SELECT {PP_COLS} FROM pp WHERE {_hour(P.STAR_AS_OF, dt.timedelta(hours=24))}
ORDER BY revenue DESC NULLS FIRST, window_start, product_id""",

    "total_metrics": f"""WITH {SUMMARY}
SELECT CAST(SUM(total_transactions) AS BIGINT) AS sum_total_transactions,
       CAST(SUM(total_revenue) AS DOUBLE) AS sum_total_revenue,
       COUNT(DISTINCT store_id) AS distinct_stores
FROM summary""",

    "recent_windows": f"""WITH {SUMMARY}
SELECT window_start, store_id, total_transactions, CAST(total_revenue AS DOUBLE) AS total_revenue
FROM summary ORDER BY window_start DESC, store_id LIMIT 10""",

    "system_stats": f"""WITH {SUMMARY}
SELECT COUNT(*) AS windows_processed, CAST(SUM(total_transactions) AS BIGINT) AS all_transactions,
       CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue, COUNT(DISTINCT store_id) AS active_stores,
       MAX(window_start) AS latest_window
FROM summary""",

    "summary_row_count": f"WITH {SUMMARY} SELECT COUNT(*) AS row_count FROM summary",

    "transactions_per_minute": f"SELECT transactions_per_minute FROM ({_cards()})",
    "revenue_per_hour": f"SELECT revenue_per_hour FROM ({_cards()})",
    "active_customers": f"SELECT active_customers FROM ({_cards()})",
    "events_per_second": f"SELECT events_per_second FROM ({_cards()})",

    "percent_change": f"""WITH {SUMMARY},
h AS (SELECT date_trunc('hour', window_start) AS hour_start,
             CAST(SUM(total_transactions) AS BIGINT) AS transactions,
             SUM(total_revenue) AS revenue
      FROM summary GROUP BY 1)
SELECT c.hour_start, c.transactions, CAST(c.revenue AS DOUBLE) AS revenue,
       p.transactions AS prev_transactions, CAST(p.revenue AS DOUBLE) AS prev_revenue,
       {ratio_sql('abs(c.transactions - p.transactions) * 100', 'p.transactions', 1)} AS transactions_change_pct,
       {ratio_sql('abs(CAST(c.revenue * 100 AS BIGINT) - CAST(p.revenue * 100 AS BIGINT)) * 100',
                  'CAST(p.revenue * 100 AS BIGINT)', 1)} AS revenue_change_pct
FROM h c LEFT JOIN h p ON p.hour_start + INTERVAL '1 hour' = c.hour_start""",

    "active_categories": f"""SELECT COUNT(DISTINCT category) AS active_categories FROM ({_top_products()})""",

    "revenue_by_store": f"SELECT store_id, revenue FROM ({_top_stores()})",

    "transaction_velocity": f"""WITH {TX},
g AS (SELECT {sql_ts(P.EVENTS_AS_OF - dt.timedelta(minutes=P.VELOCITY_MINUTES))}
             + to_minutes(CAST(i AS BIGINT)) AS minute_start
      FROM range({P.VELOCITY_MINUTES}) t(i)),
c AS (SELECT date_trunc('minute', event_time) AS minute_start, COUNT(transaction_id) AS n
      FROM tx WHERE {_in('event_time', P.EVENTS_AS_OF - dt.timedelta(minutes=P.VELOCITY_MINUTES), P.EVENTS_AS_OF)}
      GROUP BY 1)
SELECT g.minute_start, CAST(COALESCE(c.n, 0) AS BIGINT) AS transactions
FROM g LEFT JOIN c ON g.minute_start = c.minute_start""",

    "activity_heatmap": f"""WITH {TX},
g AS (SELECT CAST(i // 24 + 1 AS INTEGER) AS day_of_week, CAST(i % 24 AS INTEGER) AS hour
      FROM range(168) t(i)),
c AS (SELECT CAST(isodow(event_time) AS INTEGER) AS day_of_week, CAST(hour(event_time) AS INTEGER) AS hour,
             COUNT(transaction_id) AS n, SUM(amount) AS revenue
      FROM tx GROUP BY 1, 2)
SELECT g.day_of_week, ([{_day_names}])[g.day_of_week] AS day_name, g.hour,
       CAST(COALESCE(c.n, 0) AS BIGINT) AS transactions,
       CAST(COALESCE(c.revenue, 0) AS DOUBLE) AS revenue
FROM g LEFT JOIN c ON g.day_of_week = c.day_of_week AND g.hour = c.hour""",

    "data_quality": """WITH m AS (
  SELECT event_id IS NOT NULL AND ts IS NOT NULL AND event_type IS NOT NULL AND user_id IS NOT NULL
         AND value IS NOT NULL AND event_id % 97 <> 0 AND event_id % 89 <> 0 AS ok FROM events)
SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE ok) AS valid_records,
       COUNT(*) FILTER (WHERE NOT ok) AS invalid_records,
       CASE WHEN COUNT(*) > 0 THEN CAST((2 * COUNT(*) FILTER (WHERE ok) * 10000 + COUNT(*))
              // (2 * COUNT(*)) AS DOUBLE) / 100 END AS quality_pct
FROM m""",

    "summary_exact": f"""WITH {TX}
SELECT COUNT(transaction_id) AS total_transactions,
       CAST(COALESCE(SUM(amount), 0) AS DOUBLE) AS total_revenue,
       CAST(COALESCE({mean_sql('amount')}, 0) AS DOUBLE) AS avg_transaction_value,
       COUNT(DISTINCT customer_id) AS total_customers
FROM tx WHERE {_hour(col='event_time')}""",

    "range_store_filter": _totals(_hour(span=dt.timedelta(hours=6))
                                  + f" AND store_id = '{P.RANGE_FILTER_STORE}'"),

    "metrics_long": f"""WITH {_q3_rows()}
SELECT window_start AS metric_time, 'transactions_per_window' AS metric_name,
       CAST(CAST(transactions_per_window AS DECIMAL(10,2)) AS DOUBLE) AS metric_value, 'all' AS dimension FROM m
UNION ALL
SELECT window_start, 'revenue_per_window', CAST(CAST(revenue_per_window AS DECIMAL(10,2)) AS DOUBLE), 'all' FROM m
UNION ALL
SELECT window_start, 'avg_transaction_value', CAST(avg_transaction_value AS DOUBLE), 'all' FROM m""",

    "raw_transactions": """WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderpriority,
         o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS event_time
  FROM orders),
lt AS (
  SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS total_amount,
         SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS discount_applied
  FROM lineitem GROUP BY 1)
SELECT CAST(o.o_orderkey AS VARCHAR) AS transaction_id, o.event_time AS "timestamp",
       n.n_name AS store_id, CAST(c.c_custkey AS VARCHAR) AS customer_id, c.c_mktsegment AS customer_type,
       CAST(CAST(COALESCE(lt.total_amount, 0) AS DECIMAL(10,2)) AS DOUBLE) AS total_amount,
       o.o_orderpriority AS payment_method,
       CAST(CAST(COALESCE(lt.discount_applied, 0) AS DECIMAL(10,2)) AS DOUBLE) AS discount_applied,
       CAST(CAST(COALESCE(lt.total_amount, 0) - COALESCE(lt.discount_applied, 0) AS DECIMAL(10,2)) AS DOUBLE)
         AS final_amount
FROM o LEFT JOIN lt ON lt.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey""",

    "insert_if_absent": f"""{MERGE_SIDES}
SELECT {TUMBLING_COLS} FROM existing
UNION ALL
SELECT {TUMBLING_COLS} FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.window_start = b.window_start AND e.store_id = b.store_id)""",

    "upsert_summary": f"""{MERGE_SIDES}
SELECT {TUMBLING_COLS} FROM existing e
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE e.window_start = b.window_start AND e.store_id = b.store_id)
UNION ALL
SELECT {TUMBLING_COLS} FROM batch""",

    "approx_within_tolerance": f"""WITH {TX}
SELECT store_id, COUNT(DISTINCT customer_id) AS exact_customers, TRUE AS within_tolerance
FROM tx GROUP BY store_id""",

    "stored_summary_last_hour": _totals(_hour()),

    "stored_top_products": _top_products(),

    "stream_store_summary": f"""WITH {BAD_SUMMARY}
SELECT window_start, window_end, store_id, total_transactions, CAST(total_revenue AS DOUBLE) AS total_revenue,
       CAST(avg_transaction_value AS DOUBLE) AS avg_transaction_value, TRUE AS unique_within_tolerance
FROM summary WHERE store_id IS NOT NULL AND {BAD_CLOSED}""",

    "stream_rejected_rows": f"""WITH {BAD_SUMMARY}
SELECT 'store_id is null' AS reject_reason, COUNT(*) AS rows,
       CAST(SUM(total_transactions) AS BIGINT) AS transactions
FROM summary WHERE store_id IS NULL AND {BAD_CLOSED}""",

    "streamed_then_backfilled_summary": f"""WITH {SUMMARY}
SELECT window_start, window_end, store_id, total_transactions, CAST(total_revenue AS DOUBLE) AS total_revenue,
       CAST(avg_transaction_value AS DOUBLE) AS avg_transaction_value
FROM summary WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL '1 minute'""",

    "stream_progress": f"""SELECT 'store_window_summary' AS query_name, COUNT(*) AS input_rows, COUNT(*) AS total_records,
       COUNT(*) FILTER (WHERE event_id % 97 <> 0 AND event_id % 89 <> 0) AS valid_records,
       COUNT(*) FILTER (WHERE {_in('ts', P.LATE_START, P.LATE_END)}) > 0 AS late_rows_dropped
FROM events""",

    "processing_latency": """WITH d AS (
  SELECT date_diff('day', o_orderdate, l_shipdate) AS x FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT COUNT(x) AS rows, CAST((2 * SUM(x) + COUNT(x)) // (2 * COUNT(x)) AS BIGINT) AS avg_latency,
       CAST(quantile_disc(x, 0.95) AS BIGINT) AS p95_latency, CAST(quantile_disc(x, 0.99) AS BIGINT) AS p99_latency
FROM d""",

    "data_flow_stopped": "SELECT FALSE AS data_flow",

    "exported_csv": f"""WITH {SUMMARY}
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, store_id, total_transactions,
       CAST(total_revenue AS DOUBLE) AS total_revenue,
       CAST(avg_transaction_value AS DOUBLE) AS avg_transaction_value, unique_customers, TRUE AS created_at
FROM summary WHERE {_hour(span=dt.timedelta(hours=24))}""",

    "exported_json": f"""WITH {STAR_ITEMS}
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, product_id, product_name, category,
       quantity_sold, CAST(revenue AS DOUBLE) AS revenue, TRUE AS created_at
FROM pp WHERE {_hour(P.STAR_AS_OF, dt.timedelta(hours=24))}""",

    "export_manifest": f"""WITH {SUMMARY}, {STAR_ITEMS},
n AS (SELECT (SELECT COUNT(*) FROM summary WHERE {_hour(span=dt.timedelta(hours=24))}) AS transactions_summary,
             (SELECT COUNT(*) FROM pp WHERE {_hour(P.STAR_AS_OF, dt.timedelta(hours=24))}) AS product_performance)
SELECT *, transactions_summary + product_performance AS total_records FROM n""",

    "stream_product_performance": f"""WITH {STAR_ITEMS}
SELECT {PP_COLS} FROM pp
WHERE window_start + INTERVAL '5 minutes' <=
      (SELECT MAX(i.event_time) FROM items i JOIN prod p ON i.product_id = p.product_id) - INTERVAL '1 minute'""",

    "stream_realtime_metrics": f"""WITH {_q3_rows()},
c AS (SELECT * FROM m WHERE window_start + INTERVAL '30 seconds' <= (SELECT MAX(ts) FROM events) - INTERVAL '1 minute')
SELECT window_start AS metric_time, 'transactions_per_window' AS metric_name,
       CAST(CAST(transactions_per_window AS DECIMAL(10,2)) AS DOUBLE) AS metric_value, 'all' AS dimension FROM c
UNION ALL
SELECT window_start, 'revenue_per_window', CAST(CAST(revenue_per_window AS DECIMAL(10,2)) AS DOUBLE), 'all' FROM c
UNION ALL
SELECT window_start, 'avg_transaction_value', CAST(avg_transaction_value AS DOUBLE), 'all' FROM c""",

    "merged_summary_table": f"""{MERGE_SIDES}
SELECT {TUMBLING_COLS} FROM existing e
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE e.window_start = b.window_start AND e.store_id = b.store_id)
UNION ALL
SELECT {TUMBLING_COLS} FROM batch""",

    "stored_sketch_customers": f"""WITH {TX}
SELECT store_id, COUNT(DISTINCT customer_id) AS exact_customers, TRUE AS within_tolerance
FROM tx WHERE {_hour(col='event_time')} GROUP BY store_id""",

    "sketch_customers_last_hour": f"""WITH {TX}
SELECT store_id, COUNT(DISTINCT customer_id) AS exact_customers, TRUE AS within_tolerance
FROM tx WHERE {_hour(col='event_time')} GROUP BY store_id""",

    "stream_raw_transactions": """SELECT CAST(event_id AS VARCHAR) AS transaction_id, ts AS "timestamp",
       event_type AS store_id, CAST(user_id AS VARCHAR) AS customer_id,
       CAST(NULL AS VARCHAR) AS customer_type,
       CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS total_amount,
       CAST(NULL AS VARCHAR) AS payment_method, CAST(NULL AS DOUBLE) AS discount_applied,
       CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS final_amount
FROM events""",

    "stream_raw_transactions_other_days": """SELECT CAST(event_id AS VARCHAR) AS transaction_id, ts AS "timestamp",
       event_type AS store_id, CAST(user_id AS VARCHAR) AS customer_id,
       CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS final_amount
FROM events""",

    "stream_store_summary_panes": f"""WITH {SUMMARY}
SELECT window_start, window_end, store_id, total_transactions, CAST(total_revenue AS DOUBLE) AS total_revenue,
       CAST(avg_transaction_value AS DOUBLE) AS avg_transaction_value
FROM summary WHERE {CLOSED}""",

    "versioned_summary": f"""{MERGE_SIDES}
SELECT {TUMBLING_COLS} FROM existing e
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE e.window_start = b.window_start AND e.store_id = b.store_id)
UNION ALL
SELECT {TUMBLING_COLS} FROM batch""",

    "merged_latency": """WITH d AS (
  SELECT date_diff('day', o_orderdate, l_shipdate) AS x FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT COUNT(x) AS rows, CAST((2 * SUM(x) + COUNT(x)) // (2 * COUNT(x)) AS BIGINT) AS avg_latency,
       CAST(MIN(x) AS BIGINT) AS least_latency, CAST(MAX(x) AS BIGINT) AS most_latency,
       TRUE AS p95_within, TRUE AS p99_within
FROM d""",

    "rollup_totals_all_time": f"WITH {SUMMARY} {ROLLUP} FROM summary",

    "rollup_totals_of_range": f"WITH {SUMMARY} {ROLLUP} FROM summary WHERE {_in('window_start', P.ROLLUP_START, P.ROLLUP_END)}",

    "polled_change": _polled(),

    "late_rows_repaired": f"""WITH {SUMMARY}
SELECT window_start, window_end, store_id, total_transactions, CAST(total_revenue AS DOUBLE) AS total_revenue,
       CAST(avg_transaction_value AS DOUBLE) AS avg_transaction_value
FROM summary WHERE {CLOSED}""",

    "customer_sessions": f"WITH {SESSIONS} SELECT * FROM sessions",

    "stream_customer_sessions": f"""WITH {SESSIONS}
SELECT * FROM sessions
WHERE session_end + INTERVAL '{P.SESSION_GAP_MINUTES} minutes' <= (SELECT MAX(ts) FROM events) - INTERVAL '1 minute'""",

    "stock_levels": STOCK,

    "stream_stock_levels": STOCK,

    "stream_open_windows": f"""WITH {SUMMARY}
SELECT window_start, window_end, store_id, total_transactions, CAST(total_revenue AS DOUBLE) AS total_revenue,
       CAST(avg_transaction_value AS DOUBLE) AS avg_transaction_value, {CLOSED} AS closed
FROM summary""",

    "streams_from_decoded": TABLE_FIGURES,

    "all_streams": f"{TABLE_FIGURES} UNION ALL SELECT 'transactions', COUNT(*), COUNT(*) FROM events",

    "rates_of_whole_range": _cards(_in("window_start", P.WHOLE_RANGE_START, P.WHOLE_RANGE_END), "transactions_per_minute, events_per_second"),
}
