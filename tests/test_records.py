import json

from helpers import seconds_of

from tickflow.functions.records import HIGHER, LOWER, MICROS_FORMAT, MOVING, TICK, ZSCORE, decode, encode
from tickflow.operators import moving, shortest, ticks as ops, zscore
from tickflow.plans.params import REFERENCE

PARAMS = REFERENCE.only("30s", "1m")


def texts(messages):
    return [json.loads(r["value"]) for r in messages.collect()]


def test_tick_text(make_ticks):
    assert [r["value"] for r in encode(make_ticks((0.3, 1.5)), TICK).collect()] == [
        '{"symbol":"S","price":1.5,"event_time":"2024-03-01T00:00:00.300Z"}'
    ]


def test_time_text_is_utc_in_any_session(spark, make_ticks):
    ticks = make_ticks((0.3, 1.5))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert texts(encode(ticks, TICK))[0]["event_time"] == "2024-03-01T00:00:00.300Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_null_fields_are_dropped_unless_kept(make_ticks):
    records = moving.as_array(moving.moving_stats(make_ticks((1, 2.0)), PARAMS), PARAMS)
    assert "std_price" not in texts(encode(records, MOVING))[0]["windows"][0]
    assert texts(encode(records, MOVING, keep_nulls=True))[0]["windows"][0]["std_price"] is None


def test_microseconds_on_request(make_ticks):
    ticks = make_ticks((0.123456, 1.0))
    assert seconds_of(decode(encode(ticks, TICK), TICK).first()["event_time"]) == 0.123
    exact = encode(ticks, TICK, timestamp_format=MICROS_FORMAT)
    assert seconds_of(decode(exact, TICK).first()["event_time"]) == 0.123456


def test_nested_round_trip(make_ticks):
    ticks = make_ticks((1, 1.0), (2, 4.0), (10, 3.0))
    records = moving.as_array(moving.moving_stats(ticks, PARAMS), PARAMS)
    assert sorted(decode(encode(records, MOVING), MOVING).collect()) == sorted(records.collect())
    scores = zscore.zscore(ticks, records, PARAMS)
    assert decode(encode(scores, ZSCORE), ZSCORE).collect() == scores.collect()


def test_higher_and_lower_texts(make_ticks):
    rows = shortest.shortest_windows(make_ticks((0, 1.0), (5, 2.0)), REFERENCE)
    assert texts(encode(rows.orderBy("timestamp"), HIGHER))[0] == {
        "timestamp": "2024-03-01T00:00:00.000Z",
        "higher_window": 5.0,
    }
    assert texts(encode(rows.orderBy("timestamp"), LOWER))[0]["lower_window"] == 20.0


def test_malformed_messages_give_nulls_and_are_filtered_by_valid_ticks(spark):
    values = [
        '{"symbol":"S","price":1.0,"event_time":"2024-03-01T00:00:00.000Z"}',
        '{"symbol":"S","price":1.0,"event_time":"2024-03-01T00:00:00.000Z","more":[1]}',
        '{"symbol":"S","price":"1.0","event_time":"2024-03-01T00:00:00.000Z"}',
        '{"symbol":"S","price":1.0,"event_time":"later"}',
        '{"symbol":"S"',
        "",
        None,
    ]
    messages = spark.createDataFrame([(v.encode() if v is not None else None,) for v in values], "value binary")
    ticks = decode(messages, TICK)
    assert ticks.count() == len(values)
    assert [r["price"] for r in ticks.collect()] == [1.0, 1.0, None, 1.0, None, None, None]
    assert ops.valid_ticks(ticks).count() == 2
