"""Properties of the operators and of exact rounding."""

from fractions import Fraction

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from tillstream.functions.money import round_half_up_ratio
from tillstream.operators import insight, windows
from tillstream.plans import plan_text
from tillstream.sources import testdata


def test_sliding_counts_twice_tumbling_once(spark):
    tx = testdata.event_transactions(spark, SF001)
    n = tx.count()
    q1 = windows.store_window_summary(tx, watermark=None).agg(F.sum("total_transactions")).first()[0]
    q16 = windows.store_tumbling_summary(tx, watermark=None).agg(F.sum("total_transactions")).first()[0]
    assert (q1, q16) == (2 * n, n)


def test_heatmap_has_every_cell_and_every_row(spark):
    tx = testdata.event_transactions(spark, SF001)
    hm = insight.activity_heatmap(tx)
    assert hm.count() == 168
    assert hm.agg(F.sum("transactions")).first()[0] == tx.count()


def test_exact_summary_matches_brute_force(spark):
    tx = testdata.event_transactions(spark, SF001)
    r = insight.summary_exact(tx).first()
    rows = tx.select("customer_id", "final_amount").collect()
    cents = sum(round(Fraction(str(x.final_amount)) * 100) for x in rows)
    assert r.total_transactions == len(rows)
    assert r.total_revenue * 100 == cents
    assert r.total_customers == len({x.customer_id for x in rows})
    mean_cents = (Fraction(cents, len(rows)) + Fraction(1, 2)).__floor__()
    assert r.avg_transaction_value * 100 == mean_cents


def test_hot_store_is_reduced_before_the_shuffle(spark):
    """A third of all rows on one store: results stay exact and the plan
    aggregates partially before exchanging (no task receives the raw rows)."""
    tx = testdata.event_transactions(spark, SF001).withColumn(
        "store_id", F.when(F.col("transaction_id").cast("bigint") % 3 == 0, F.lit("hot"))
        .otherwise(F.col("store_id")))
    summary = windows.store_tumbling_summary(tx, watermark=None, window="1 day")
    got = {r.store_id: r.n for r in summary.groupBy("store_id")
           .agg(F.sum("total_transactions").alias("n")).collect()}
    want = {r.store_id: r["count"] for r in tx.groupBy("store_id").count().collect()}
    assert got == want
    plan = plan_text(summary)
    assert plan.index("partial_count") > plan.index("Exchange")  # partial below the exchange


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**6)), min_size=1, max_size=20),
       st.integers(0, 3))
def test_round_half_up_ratio_is_exact(spark_hyp, pairs, scale):
    df = spark_hyp.createDataFrame(pairs, "num bigint, den bigint")
    got = [r[0] for r in df.select(
        round_half_up_ratio(F.col("num"), F.col("den"), scale, "decimal(38,3)")).collect()]
    want = [(Fraction(n * 10**scale, d) + Fraction(1, 2)).__floor__() / Fraction(10**scale)
            for n, d in pairs]
    assert [Fraction(g) for g in got] == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**13), st.integers(1, 10**13)), min_size=1, max_size=20))
def test_round_half_up_ratio_is_exact_for_large_counts(spark_hyp, pairs):
    pairs = [*pairs, (6181015002081500, 77014643953410)]
    df = spark_hyp.createDataFrame(pairs, "num bigint, den bigint")
    got = [r[0] for r in df.select(round_half_up_ratio(F.col("num"), F.col("den"), 2, "decimal(38,2)")).collect()]
    want = [(Fraction(n * 100, d) + Fraction(1, 2)).__floor__() / Fraction(100) for n, d in pairs]
    assert [Fraction(g) for g in got] == want


def test_sketch_union_counts_each_customer_once(spark):
    from conftest import SF01
    from tillstream.operators import rollups
    tx = testdata.event_transactions(spark, SF01)
    sketched = windows.store_tumbling_summary(tx, watermark=None, sketch=True)
    est = {r.store_id: r.distinct_customers for r in rollups.distinct_customers(sketched).collect()}
    exact = {r.store_id: r.n for r in tx.groupBy("store_id").agg(F.count_distinct("customer_id").alias("n")).collect()}
    summed = {r.store_id: r.n for r in sketched.groupBy("store_id").agg(F.sum("unique_customers").alias("n")).collect()}
    assert est.keys() == exact.keys()
    for k in exact:
        assert abs(est[k] - exact[k]) <= 0.05 * exact[k]
        assert summed[k] > exact[k]  # the reference's sum over windows overstates
