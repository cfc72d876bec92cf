"""Helpers: time ranges, day-partition bounds, size-checked broadcast."""

import datetime as dt

from pyspark.sql import functions as F

from tillstream.functions.timebounds import TimeRange, trailing
from tillstream.plans import broadcast_bounded, plan_text
from tillstream.sources.tables import _date_bound

T = dt.datetime(2024, 1, 15, 12, 0)


def test_trailing_and_widen():
    r = trailing(T, "1h", until=T)
    assert (r.start, r.end) == (T - dt.timedelta(hours=1), T)
    assert trailing(T, "5m").end is None
    w = r.widen(after=dt.timedelta(minutes=1))
    assert (w.start, w.end) == (r.start, T + dt.timedelta(minutes=1))
    assert TimeRange(None, T).widen(before=dt.timedelta(days=1)).start is None


def test_day_bounds_cover_the_range():
    d = _date_bound(TimeRange(dt.datetime(2024, 1, 14, 23, 30), dt.datetime(2024, 1, 15, 0, 10)))
    assert (d.start, d.end) == (dt.datetime(2024, 1, 14), dt.datetime(2024, 1, 16))


def test_time_range_predicate_is_half_open(spark):
    df = spark.createDataFrame([(T - dt.timedelta(hours=1),), (T,), (T - dt.timedelta(seconds=1),)], "t timestamp")
    rng = trailing(T, "1h", until=T)
    assert df.where(rng.predicate(F.col("t"))).count() == 2


def test_month_bounds_cover_the_range():
    d = _date_bound(TimeRange(dt.datetime(2024, 1, 14, 23, 30), dt.datetime(2024, 2, 1)), "month")
    assert (d.start, d.end) == (dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 2))


def test_broadcast_needs_a_bound(spark):
    import pytest
    left = spark.range(5000).withColumnRenamed("id", "k")
    joined = left.join(broadcast_bounded(spark.range(10), 10), F.col("k") == F.col("id"))
    assert "BroadcastHashJoin" in plan_text(joined)
    with pytest.raises(ValueError):
        broadcast_bounded(left, 2_000_000)


def test_trailing_defaults_to_now():
    before = dt.datetime.now().replace(microsecond=0)
    r = trailing(None, "1h")
    assert before - dt.timedelta(hours=1) <= r.start <= dt.datetime.now() - dt.timedelta(hours=1)
