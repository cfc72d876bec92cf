"""Sinks: contracts, idempotent batch writes, exports, JDBC (embedded Derby)."""

import datetime as dt
import glob
import json
import os
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF001, SF01
from tillstream.contract.queries import event_summary
from tillstream.functions.timebounds import TimeRange
from tillstream.operators.keyed import upsert
from tillstream.schemas import TRANSACTIONS_SUMMARY
from tillstream.sinks.contracts import conform
from tillstream.sinks.export import export_csv, export_json
from tillstream.sinks.jdbc import _execute, JdbcBatchWriter, jdbc_append, jdbc_insert_if_absent, jdbc_options, jdbc_read
from tillstream.sinks.parquet import IdempotentBatchWriter, write_table
from tillstream.sources.tables import read_summary
from tillstream.plans import plan_text

T0 = dt.datetime(2025, 1, 1)


def _summary(spark, rows):
    return spark.createDataFrame(rows, "window_start timestamp, window_end timestamp, store_id string, "
                                       "total_transactions bigint, total_revenue double, "
                                       "avg_transaction_value double, unique_customers bigint")


def test_conform_casts_defaults_and_rejects(spark):
    df = _summary(spark, [
        (T0, T0, "s", 1, 2.345, 2.345, None),
        (T0, T0, None, 1, 1.0, 1.0, 1),
        (T0, T0, "x" * 51, 1, 1.0, 1.0, 1),
    ])
    good, bad = conform(df, TRANSACTIONS_SUMMARY)
    g = good.collect()
    assert len(g) == 1 and g[0].total_revenue == Decimal("2.35") and g[0].unique_customers == 0
    assert g[0].created_at is not None
    assert sorted(r.reject_reason for r in bad.collect()) == ["store_id is null", "store_id longer than 50"]


def test_batch_writer_replay_is_idempotent(spark, scratch):
    writer = IdempotentBatchWriter(f"{scratch}/t", TRANSACTIONS_SUMMARY)
    batch = _summary(spark, [(T0, T0, "s", 1, 1.0, 1.0, 1), (T0, T0, "u", 2, 3.0, 1.5, 2)])
    writer(batch, 0)
    writer(batch, 1)
    writer(batch, 1)  # replay of batch 1
    t = spark.read.parquet(f"{scratch}/t")
    assert t.count() == 4
    assert t.groupBy("batch_id").count().count() == 2


def test_stored_table_read_prunes_partitions(spark, scratch):
    path = f"{scratch}/summary"
    write_table(event_summary(spark, SF001), path, TRANSACTIONS_SUMMARY)
    rng = TimeRange(dt.datetime(2024, 1, 15, 11), dt.datetime(2024, 1, 15, 12))
    df = read_summary(spark, path, rng)
    plan = plan_text(df)
    assert "PartitionFilters" in plan and "window_date" in plan
    assert "window_date=2024-01-15" in plan or "2024-01-15" in plan
    expected = event_summary(spark, SF001, rng)
    got = df.drop("created_at", "window_date")
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    # a range with no stored day gives an empty result, not an error
    assert read_summary(spark, path, TimeRange(dt.datetime(2030, 1, 1), dt.datetime(2030, 1, 2))).count() == 0


def test_upsert_batch_wins(spark):
    old = _summary(spark, [(T0, T0, "s", 1, 1.0, 1.0, 1), (T0, T0, "u", 1, 1.0, 1.0, 1)])
    new = _summary(spark, [(T0, T0, "s", 5, 5.0, 1.0, 1)])
    rows = {r.store_id: r.total_transactions for r in upsert(old, new, ["window_start", "store_id"]).collect()}
    assert rows == {"s": 5, "u": 1}


def test_exports(spark, scratch):
    summary = event_summary(spark, SF001)
    n = export_csv(summary, f"{scratch}/csv")
    assert n == summary.count()
    header = open(sorted(glob.glob(f"{scratch}/csv/part-*.csv"))[0]).readline().strip()
    assert header.startswith("window_start,window_end,store_id")
    products = spark.createDataFrame([(T0, "P1", 1)], "window_start timestamp, product_id string, q bigint")
    manifest = export_json(summary, products, f"{scratch}/json").first()
    assert manifest.total_records == n + 1
    lines = [ln for f in glob.glob(f"{scratch}/json/product_performance/part-*.json")
             for ln in open(f) if ln.strip()]
    assert len(lines) == 1
    assert json.loads(lines[0])["window_start"] == "2025-01-01 00:00:00"


def test_jdbc_insert_if_absent_on_embedded_derby(spark, scratch):
    url = f"jdbc:derby:{os.path.join(scratch, 'db')};create=true"
    opts = jdbc_options(url, "TRANSACTIONS_SUMMARY", driver="org.apache.derby.jdbc.EmbeddedDriver")
    base = _summary(spark, [(T0, T0, "s", 1, 1.0, 1.0, 1)]).select(
        "window_start", "store_id", F.col("total_transactions"))
    _execute(spark, opts, 'CREATE TABLE TRANSACTIONS_SUMMARY ("window_start" TIMESTAMP, "store_id" VARCHAR(50), '
                          '"total_transactions" BIGINT, PRIMARY KEY ("window_start", "store_id"))')
    jdbc_append(base, opts)
    batch = _summary(spark, [(T0, T0, "s", 9, 1.0, 1.0, 1), (T0, T0, "u", 2, 1.0, 1.0, 1)]).select(
        "window_start", "store_id", "total_transactions")
    JdbcBatchWriter(opts, ["window_start", "store_id"])(batch, 0)
    jdbc_insert_if_absent(batch, opts, ["window_start", "store_id"])
    twice = batch.unionByName(batch.where("store_id = 'u'").withColumn("store_id", F.lit("v"))).unionByName(batch)
    jdbc_insert_if_absent(twice.repartition(4), opts, ["window_start", "store_id"])
    stored = jdbc_read(spark, opts).collect()
    assert sorted((r.store_id, r.total_transactions) for r in stored) == [("s", 1), ("u", 2), ("v", 2)]


def test_merge_touches_only_batch_days_and_is_idempotent(spark, scratch):
    from tillstream.operators.windows import store_tumbling_summary
    from tillstream.schemas import TUMBLING_SUMMARY
    from tillstream.sinks.parquet import merge_into_table
    from tillstream.sources import testdata
    tx = testdata.event_transactions(spark, SF001)
    path = f"{scratch}/t"
    write_table(store_tumbling_summary(tx.where("event_time < '2024-01-20'"), watermark=None),
                path, TUMBLING_SUMMARY)
    untouched = glob.glob(f"{path}/window_date=2024-01-05/*/*.parquet")
    before = {f: os.path.getmtime(f) for f in untouched}
    batch = store_tumbling_summary(tx.where("event_time >= '2024-01-19'"), watermark=None)
    merge_into_table(batch, path, TUMBLING_SUMMARY, f"{scratch}/stage1")
    cols = ["window_start", "store_id", "total_transactions", "total_revenue", "unique_customers"]
    first = sorted(spark.read.parquet(path).select(*cols).collect())
    merge_into_table(batch, path, TUMBLING_SUMMARY, f"{scratch}/stage2")
    assert sorted(spark.read.parquet(path).select(*cols).collect()) == first
    assert {f: os.path.getmtime(f) for f in untouched} == before and before
    full = store_tumbling_summary(tx, watermark=None).select(*cols)
    assert sorted(full.collect()) == first


def test_duplicate_product_key_goes_to_rejects(spark):
    from tillstream.schemas import PRODUCT_PERFORMANCE
    rows = [(T0, "P1", "Milk", "Dairy", 1, 1.0), (T0, "P1", "Milk 2l", "Dairy", 2, 2.0),
            (T0, "P2", "Bread", "Bakery", 3, 3.0)]
    df = spark.createDataFrame(rows, "window_start timestamp, product_id string, product_name string, "
                                     "category string, quantity_sold bigint, revenue double")
    good, bad = conform(df, PRODUCT_PERFORMANCE, stamp=False)
    assert [r.product_id for r in good.collect()] == ["P2"]
    assert sorted((r.product_name, r.reject_reason) for r in bad.collect()) == [
        ("Milk", "duplicate key"), ("Milk 2l", "duplicate key")]


def test_decimal_overflow_raises_instead_of_storing_wrong_values(spark):
    import pytest
    df = _summary(spark, [(T0, T0, "s", 1, 1.0e11, 1.0, 1)])  # does not fit DECIMAL(12,2)
    good, _ = conform(df, TRANSACTIONS_SUMMARY, stamp=False)
    with pytest.raises(Exception) as e:
        good.collect()
    assert "NUMERIC_VALUE_OUT_OF_RANGE" in str(e.value) or "overflow" in str(e.value).lower()


def test_stored_sketches_answer_distinct_customers(spark, scratch):
    from tillstream.operators import rollups
    from tillstream.operators.windows import store_tumbling_summary
    from tillstream.schemas import TUMBLING_SUMMARY
    from tillstream.sources import testdata
    from tillstream.sources.tables import read_table
    tx = testdata.event_transactions(spark, SF001)
    sketched = store_tumbling_summary(tx, watermark=None, sketch=True)
    write_table(sketched, f"{scratch}/t", TUMBLING_SUMMARY)
    rng = TimeRange(dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12))
    stored = read_table(spark, f"{scratch}/t", "tumbling_summary", rng)
    got = {r.store_id: r.distinct_customers for r in rollups.distinct_customers(stored, rng).collect()}
    want = {r.store_id: r.distinct_customers for r in rollups.distinct_customers(sketched, rng).collect()}
    assert got == want and got


def test_batch_writer_keeps_rejects_with_reasons(spark, scratch):
    writer = IdempotentBatchWriter(f"{scratch}/t", TRANSACTIONS_SUMMARY)
    writer(_summary(spark, [(T0, T0, "s", 1, 1.0, 1.0, 1), (T0, T0, None, 2, 2.0, 1.0, 1)]), 0)
    assert spark.read.parquet(f"{scratch}/t").count() == 1
    rejects = spark.read.parquet(f"{scratch}/t_rejects").collect()
    assert [(r.batch_id, r.reject_reason) for r in rejects] == [(0, "store_id is null")]
    assert json.loads(rejects[0].row)["total_transactions"] == 2


def test_merge_leaves_days_without_rows_alone(spark, scratch):
    from tillstream.schemas import TUMBLING_SUMMARY
    from tillstream.sinks.parquet import merge_into_table
    days = [dt.datetime(2025, 1, d) for d in (2, 15, 28)]
    row = lambda t, n: (t, t, "s", n, 1.0, 1.0, 1)
    write_table(_summary(spark, [row(t, 1) for t in days]), f"{scratch}/t", TUMBLING_SUMMARY)
    middle = {f: os.path.getmtime(f) for f in glob.glob(f"{scratch}/t/window_date=2025-01-15/*/*.parquet")}
    merge_into_table(_summary(spark, [row(days[0], 5), row(days[2], 6)]), f"{scratch}/t", TUMBLING_SUMMARY, f"{scratch}/s")
    assert middle and {f: os.path.getmtime(f) for f in middle} == middle
    assert sorted(r.total_transactions for r in spark.read.parquet(f"{scratch}/t").collect()) == [1, 5, 6]


def test_merge_into_a_table_without_a_contract_column(spark, scratch):
    from tillstream.schemas import TUMBLING_SUMMARY
    from tillstream.sinks.parquet import merge_into_table
    old = _summary(spark, [(T0 + dt.timedelta(minutes=i), T0, "s", 1, 1.0, 1.0, 1) for i in range(36)])
    (old.withColumn("window_date", F.to_date("window_start")).withColumn("batch_id", F.lit(-1).cast("bigint"))
     .drop("avg_transaction_value").withColumn("total_revenue", F.col("total_revenue").cast("decimal(12,2)"))
     .write.partitionBy("window_date", "batch_id").parquet(f"{scratch}/t"))
    merge_into_table(_summary(spark, [(T0, T0, "s", 9, 1.0, 1.0, 1)]), f"{scratch}/t", TUMBLING_SUMMARY, f"{scratch}/s")
    rows = spark.read.parquet(f"{scratch}/t").collect()
    assert len(rows) == 36 and sum(r.total_transactions for r in rows) == 35 + 9


def test_compaction_keeps_rows_and_leaves_one_partition_a_day(spark, scratch):
    from tillstream.sinks.parquet import compact
    from tillstream.sources.tables import read_table
    writer = IdempotentBatchWriter(f"{scratch}/t", TRANSACTIONS_SUMMARY)
    for i in range(3):
        writer(_summary(spark, [(T0 + dt.timedelta(minutes=i), T0, "s", i, 1.0, 1.0, 1)]), i)
    before = sorted(read_table(spark, f"{scratch}/t", TRANSACTIONS_SUMMARY.name).collect())
    compact(spark, f"{scratch}/t", TRANSACTIONS_SUMMARY, [T0.date()], f"{scratch}/s")
    assert sorted(read_table(spark, f"{scratch}/t", TRANSACTIONS_SUMMARY.name).collect()) == before
    assert [os.path.basename(p) for p in glob.glob(f"{scratch}/t/window_date=2025-01-01/*")] == ["batch_id=-1"]


def test_a_missing_table_raises(spark, scratch):
    import pytest
    for days in (1, 400):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            read_summary(spark, f"{scratch}/none", TimeRange(T0, T0 + dt.timedelta(days=days))).collect()


def test_exports_keep_fractions_and_empty_csv_is_empty(spark, scratch):
    from tillstream.sinks.export import export_frame
    df = spark.createDataFrame([(T0,), (T0 + dt.timedelta(microseconds=120),)], "created_at timestamp")
    assert [r[0] for r in export_frame(df).collect()] == ["2025-01-01 00:00:00", "2025-01-01 00:00:00.000120"]
    assert export_csv(_summary(spark, []), f"{scratch}/e") == 0
    assert all(os.path.getsize(f) == 0 for f in glob.glob(f"{scratch}/e/part-*"))


def test_export_order(spark):
    """O2 and O3: newest windows first; highest revenue first."""
    from tillstream.contract import QUERIES
    times = [r.window_start for r in QUERIES["export_transactions"](spark, SF001).collect()]
    assert times == sorted(times, reverse=True) and times
    revenue = [r.revenue for r in QUERIES["export_products"](spark, SF01).collect()]
    assert revenue == sorted(revenue, reverse=True) and revenue


def test_orders_carry_several_items(spark):
    from tillstream.sources import testdata
    sizes = testdata.item_messages(spark, SF001).select(
        F.size(F.from_json(F.get_json_object("value", "$.items"), "array<string>")).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] > 1
