"""Hand-computed results on the seed rows of the stored tables (FIXTURES §3)."""

import datetime as dt
from decimal import Decimal

import pytest

from tillstream.functions.timebounds import trailing
from tillstream.operators import keyed, rollups

T = dt.datetime(2025, 3, 1, 12, 0, 0)
H = dt.timedelta(hours=1)


@pytest.fixture(scope="module")
def seeds(spark):
    summary = spark.createDataFrame([
        (T - H, T - dt.timedelta(minutes=55), "London-Central", 45, Decimal("2345.67"), Decimal("52.13"), 38),
        (T - H, T - dt.timedelta(minutes=55), "Manchester-North", 32, Decimal("1876.54"), Decimal("58.64"), 28),
    ], "window_start timestamp, window_end timestamp, store_id string, total_transactions bigint, "
       "total_revenue decimal(12,2), avg_transaction_value decimal(10,2), unique_customers bigint")
    products = spark.createDataFrame([
        (T - H, "P001", "Organic Milk", "Dairy", 125, Decimal("311.25")),
        (T - H, "P002", "Whole Wheat Bread", "Bakery", 89, Decimal("168.31")),
    ], "window_start timestamp, product_id string, product_name string, category string, "
       "quantity_sold bigint, revenue decimal(10,2)")
    return summary, products


def test_summary_last_hour(seeds):
    summary, _ = seeds
    r = rollups.summary_totals(summary, trailing(T, "1h")).first()
    assert (r.total_transactions, r.total_revenue, r.avg_transaction_value, r.total_customers) == \
        (77, Decimal("4222.21"), Decimal("55.385000"), 66)


def test_top_stores_and_products(seeds):
    summary, products = seeds
    stores = [r.store_id for r in rollups.top_stores(summary, trailing(T, "1h")).collect()]
    assert stores == ["London-Central", "Manchester-North"]
    prods = [r.product_name for r in rollups.top_products(products, trailing(T, "1h")).collect()]
    assert prods == ["Organic Milk", "Whole Wheat Bread"]
    assert rollups.active_categories(products, trailing(T, "1h")).first()[0] == 2


def test_activity_and_stats(seeds):
    summary, _ = seeds
    assert rollups.recent_activity(summary, trailing(T, "5m")).first()[0] == 0
    assert rollups.data_flow(summary, trailing(T, "5m")).first()[0] is False
    s = rollups.stream_stats(summary, trailing(T, "1h")).first()
    assert (s.windows_processed, s.active_stores) == (1, 2)
    assert rollups.dashboard_cards(summary, trailing(T, "1h")).first().transactions_per_minute == 1


def test_one_second_later_everything_is_zero_but_export_keeps_rows(seeds):
    summary, products = seeds
    later = T + dt.timedelta(seconds=1)
    r = rollups.summary_totals(summary, trailing(later, "1h")).first()
    assert (r.total_transactions, r.total_revenue, r.avg_transaction_value, r.total_customers) == \
        (0, Decimal("0.00"), Decimal("0E-6"), 0)
    assert rollups.export_transactions(summary, trailing(later, "24h")).count() == 2
    assert rollups.export_products(products, trailing(later, "24h")).count() == 2


def test_inserting_seeds_twice_changes_nothing(seeds):
    summary, _ = seeds
    after = keyed.table_after_insert(summary, summary, ["window_start", "store_id"])
    assert sorted(after.collect()) == sorted(summary.collect())
    assert keyed.insert_if_absent(summary, summary, ["window_start", "store_id"]).count() == 0


def test_metrics_response_matches_hand_computed(seeds):
    from tillstream.operators.dashboard import metrics_response
    summary, products = seeds
    r = metrics_response(summary, products, T)
    assert r["summary"] == {"total_transactions": 77, "total_revenue": 4222.21,
                            "avg_transaction_value": 55.385, "total_customers": 66}
    assert [s["store_id"] for s in r["stores"]] == ["London-Central", "Manchester-North"]
    assert r["products"][0] == {"product_name": "Organic Milk", "category": "Dairy",
                                "quantity": "125", "revenue": "311.25"}
    assert r["recent_activity"] == 0


def test_export_last_day_keeps_seed_rows(seeds, scratch):
    from tillstream.sinks.export import export_last_day
    summary, products = seeds
    later = T + dt.timedelta(seconds=1)
    assert export_last_day(summary, products, later, f"{scratch}/csv", "csv") == 2
    m = export_last_day(summary, products, later, f"{scratch}/json").first()
    assert (m.transactions_summary, m.product_performance, m.total_records) == (2, 2, 4)
