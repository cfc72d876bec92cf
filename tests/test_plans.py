"""Physical plans: pushdown, pruning, top-k, no Python in the hot path,
no cartesian products, aggregation before the dimension join."""

import pytest

from conftest import SF001
from tillstream.contract import QUERIES
from tillstream.contract.queries import star_products
from tillstream.plans import plan_text

BATCH = [n for n in QUERIES if not n.startswith(("stream", "stored_", "export_manifest", "exported_"))]


@pytest.mark.parametrize("name", sorted(BATCH))
def test_no_python_no_cartesian(spark, name):
    plan = plan_text(QUERIES[name](spark, SF001))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name", ["summary_last_hour", "top_stores", "transaction_velocity",
                                  "summary_exact", "recent_activity"])
def test_trailing_range_reaches_the_scan(spark, name):
    plan = plan_text(QUERIES[name](spark, SF001))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan, plan


def test_top_k_is_take_ordered(spark):
    for name in ("top_stores", "top_products", "recent_windows"):
        assert "TakeOrderedAndProject" in plan_text(QUERIES[name](spark, SF001)), name


def test_projection_pruned_at_scan(spark):
    plan = plan_text(QUERIES["summary_exact"](spark, SF001))
    scan = [ln for ln in plan.splitlines() if "ReadSchema" in ln][0]
    assert "props" not in scan


def test_products_aggregate_before_dimension_join(spark):
    plan = plan_text(star_products(spark, SF001), "simple")
    lines = plan.splitlines()
    agg = min(i for i, ln in enumerate(lines) if "HashAggregate" in ln)
    part_scan = [i for i, ln in enumerate(lines) if "part.parquet" in ln or "p_partkey" in ln and "Scan" in ln]
    # the final aggregate sits below (after, in text order) no join with part:
    # the dimension join is above the aggregate in the tree
    join = min(i for i, ln in enumerate(lines) if "Join" in ln)
    assert join < agg and part_scan


def test_store_and_range_filters_reach_the_scan(spark):
    plan = plan_text(QUERIES["range_store_filter"](spark, SF001))
    pushed = [ln for ln in plan.splitlines() if "PushedFilters" in ln][0]
    assert "EqualTo(event_type,purchase)" in pushed
    assert "GreaterThanOrEqual(ts," in pushed and "LessThan(ts," in pushed


def test_window_aggregations_combine_map_side(spark):
    for name in ("store_window_summary", "store_tumbling_summary", "realtime_window_metrics",
                 "product_window_performance", "activity_heatmap"):
        plan = plan_text(QUERIES[name](spark, SF001), "simple")
        # a partial aggregate sits below (after, in the text) the first exchange
        first_exchange = plan.index("Exchange")
        assert "partial_" in plan[first_exchange:], name


def test_trailing_star_query_filters_lineitem_at_runtime(spark):
    """lineitem has no time column; at scale the join gets a runtime bloom
    filter on l_orderkey built from the hour's orders, applied before the
    shuffle (thresholds scaled down to the test data)."""
    from test_skew import conf
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                      "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1KB"}):
        plan = plan_text(QUERIES["top_products"](spark, SF001), "extended")
    assert "might_contain" in plan and "xxhash64(l_orderkey" in plan


def test_exact_distinct_shuffles_by_customer_first(spark):
    """count(distinct customer) per (window, store): the first exchange is on
    (window, store, customer) after a map-side de-duplication, so a hot store's
    customers are spread over tasks before the per-store count."""
    plan = plan_text(QUERIES["store_window_summary_exact"](spark, SF001), "simple")
    exchanges = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
    assert any("customer_id" in ln for ln in exchanges), exchanges


def test_store_windows_aggregate_in_codegen(spark):
    for name in ("store_window_summary", "store_tumbling_summary"):
        assert "ObjectHashAggregate" not in plan_text(QUERIES[name](spark, SF001)), name


def test_hourly_change_scans_once(spark):
    plan = plan_text(QUERIES["percent_change"](spark, SF001), "simple")
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_streams_decode_only_their_fields(spark, scratch):
    from tillstream.sources.streams import text_stream
    from tillstream.streaming import jobs
    (spark.range(1).selectExpr("'x' AS value")).write.text(f"{scratch}/in")
    raw = text_stream(spark, f"{scratch}/in")
    for build, used, unused in ((jobs.store_summary_stream, ("customer_id",), ("items", "payment_method")),
                                (jobs.metrics_stream, ("final_amount",), ("items", "customer_id")),
                                (jobs.product_stream, ("items",), ("customer_id", "final_amount")),
                                (jobs.raw_transactions_stream, ("payment_method",), ("items",))):
        plan = build(raw)._jdf.queryExecution().analyzed().toString()
        fields = plan[plan.index("from_json"):].split("\n")[0]
        assert all(f"StructField({f}," in fields for f in used), fields
        assert not any(f"StructField({f}," in fields for f in unused), fields
