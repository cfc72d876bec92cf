"""A hot join key (a third of all line items on one order) is split by AQE's
skew-join handling, and the results stay exact."""

import contextlib

import duckdb
from pyspark.sql import functions as F

from conftest import SF01
from oracle_util import _rows
from tillstream.contract.oracle import ORACLE
from tillstream.contract.queries import plain, star_products
from tillstream.plans import plan_text

SCALED_DOWN = {
    # as if every table were too large to broadcast
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    # skew thresholds scaled to the test's data size
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16384",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_order_key(spark, scratch):
    d = f"{scratch}/sf"
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(0).cast("bigint"))
                        .otherwise(F.col("l_orderkey")))
    # several files -> several map tasks: AQE splits a skewed partition along
    # map-output boundaries, as on any real table
    hot.repartition(8).write.parquet(f"{d}/lineitem.parquet")
    for t in ("orders", "part"):
        spark.read.parquet(f"{SF01}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    with conf(spark, SCALED_DOWN):
        df = plain(star_products(spark, d))
        got = df.toArrow()
        plan = plan_text(df, "simple")
    assert "skew=true" in plan, plan
    con = duckdb.connect()
    for t in ("lineitem", "orders", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet/*.parquet')")
    want = con.sql(ORACLE["product_window_performance"]).arrow()
    if hasattr(want, "read_all"):
        want = want.read_all()
    assert got.num_rows == want.num_rows
    assert _rows(got) == _rows(want)
