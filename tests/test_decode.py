"""Decoder and validity rule on adversarial messages (FIXTURES §6)."""

from tillstream.operators.insight import data_quality
from tillstream.sources.decode import parse_messages

GOOD = ('{"transaction_id":"t1","timestamp":"2025-01-01T00:00:05","store_id":"s","customer_id":"c",'
        '"items":[{"product_id":"P1","product_name":"n","category":"k","quantity":2,"unit_price":1.5,"total":3.0}],'
        '"total_amount":3.0,"final_amount":3.0}')


def _parse(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return parse_messages(df, "transactions")


def test_bad_values_are_invalid_and_never_raise(spark):
    rows = _parse(spark, [
        "{bad", "[1]", "", None,
        '{"transaction_id":"t2","timestamp":"2025-01-01T00:00:05","store_id":"s","total_amount":1.0,"final_amount":1.0}',
        '{"transaction_id":"t3","timestamp":"nope","store_id":"s","customer_id":"c","total_amount":1.0,"final_amount":1.0}',
    ]).collect()
    assert [r.is_valid for r in rows] == [False] * 6


def test_wrong_type_nulls_one_field_keeps_others(spark):
    r = _parse(spark, ['{"transaction_id":"t4","timestamp":"2025-01-01T00:00:05","store_id":"s",'
                       '"customer_id":"c","total_amount":1.0,"final_amount":"x"}']).first()
    assert r.final_amount is None and r.store_id == "s" and r.is_valid is False


def test_good_message_and_empty_items(spark):
    rows = _parse(spark, [GOOD, GOOD.replace('"items":[{', '"items":[],"x":[{')]).collect()
    assert all(r.is_valid for r in rows)
    assert rows[0].items[0].quantity == 2
    assert str(rows[0].event_time) == "2025-01-01 00:00:05"


def test_data_quality_counts(spark):
    parsed = _parse(spark, [GOOD, GOOD, GOOD, "{bad"])
    r = data_quality(parsed).first()
    assert (r.total_records, r.valid_records, r.invalid_records, str(r.quality_pct)) == (4, 3, 1, "75.00")


def test_inventory_and_customer_messages(spark):
    inv = spark.createDataFrame([
        ('{"event_id":"i1","timestamp":"2025-01-01T00:00:01","store_id":"s","product_id":"P1",'
         '"product_name":"n","event_type":"restock","quantity_change":-5,"current_stock":40,'
         '"reorder_level":50,"alert":true}',),
        ('{"event_id":"i2","timestamp":"2025-01-01T00:00:01","store_id":"s"}',),
    ], "value string")
    rows = parse_messages(inv, "inventory").collect()
    assert [r.is_valid for r in rows] == [True, False]
    assert (rows[0].quantity_change, rows[0].alert) == (-5, True)
    cust = spark.createDataFrame([
        ('{"event_id":"c1","timestamp":"2025-01-01T00:00:01","customer_id":"C1","event_type":"login",'
         '"store_id":"s","session_duration":30,"page_views":3,"device":"mobile","channel":"app"}',),
    ], "value string")
    r = parse_messages(cust, "customer_events").first()
    assert r.is_valid and r.page_views == 3


def test_console_sink_runs(spark, scratch):
    import json as _json
    from tillstream.operators.windows import realtime_window_metrics
    from tillstream.sources.decode import transactions_from_messages
    from tillstream.sources.streams import text_stream
    from tillstream.streaming.jobs import run_to_console
    import os
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/a.txt", "w") as fh:
        fh.write(_json.dumps({"transaction_id": "t", "timestamp": "2025-01-01T00:00:01", "store_id": "s",
                              "customer_id": "c", "total_amount": 1.0, "final_amount": 1.0}) + "\n")
    q = run_to_console(realtime_window_metrics(transactions_from_messages(text_stream(spark, f"{scratch}/in"))),
                       {"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=10))
def test_arbitrary_text_never_raises_and_is_never_valid(spark_hyp, values):
    rows = _parse(spark_hyp, values).select("is_valid").collect()
    assert len(rows) == len(values)
    assert not any(r.is_valid for r in rows)


def test_reject_reasons(spark):
    from tillstream.operators.insight import reject_reasons
    parsed = _parse(spark, [
        GOOD, "{bad", "", None,
        '{"transaction_id":"t2","timestamp":"2025-01-01T00:00:05","store_id":"s","total_amount":1.0,"final_amount":1.0}',
        '{"transaction_id":"t3","timestamp":"nope","store_id":"s","customer_id":"c","total_amount":1.0,"final_amount":1.0}',
    ])
    got = {r.reason: r.messages for r in reject_reasons(parsed).collect()}
    assert got == {"unparseable": 3, "missing customer_id": 1, "bad timestamp": 1}


def test_a_condition_on_decoded_columns_does_not_parse_the_text_again(spark):
    raw = spark.createDataFrame([('{"event_id": "1", "timestamp": "2024-01-01T00:00:00", "store_id": "s", "product_id": "p"}',),
                                 ("{bad",), (None,), ("",), ("[1]",)], "value string")
    told = parse_messages(raw, "inventory").where("store_id IS NOT NULL AND product_id IS NOT NULL AND event_time IS NOT NULL")
    assert told._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert [r.event_id for r in told.collect()] == ["1"]
    assert [r.event_id for r in parse_messages(raw, "inventory").collect()] == ["1", None, None, None, None]
