"""Each rule on hand-written payloads; expected values follow from the rules' description."""

import datetime

import pytest
from pyspark.sql import functions as F

from orderflow.operators import normalize as N


STAMP = '"2026-06-02T10:00:00+00:00"'

CASES = [
    # (payload, [(event_type, order_id, status, courier_id, available, format, has_time)])
    ('{"event_type":"ORDER_CREATED","order_id":"7","client_id":1,"status":"pending","timestamp":%s}' % STAMP,
     [("ORDER_CREATED", 7, "PENDING", None, None, "flat_order_event_v2", True)]),
    ('{"event_type":" order_status_changed ","order_id":"7","new_status":"","status":"Confirmed"}',
     [("STATUS_CHANGE", 7, "CONFIRMED", None, None, "flat_order_event_v2", False)]),
    ('{"event_type":"ORDER_COURIER_ASSIGNED","order_id":"x","courier_id":"3"}',
     [("COURIER_ASSIGNED", None, None, 3, None, "flat_order_event_v2", False)]),
    ('{"order_id":7,"event_type":"STATUS_CHANGE","from_status":null,"to_status":"PENDING","created_at":%s}' % STAMP,
     [("ORDER_CREATED", 7, "PENDING", None, None, "flat_order_event", True)]),
    ('{"order_id":7,"event_type":"STATUS_CHANGE","from_status":"X","to_status":"PENDING"}',
     [("STATUS_CHANGE", 7, "PENDING", None, None, "flat_order_event", False)]),
    ('{"order_id":7,"to_status":"ready"}', [("ORDER_EVENT", 7, "READY", None, None, "flat_order_event", False)]),
    ('{"order_id":7,"event_type":null}', [("NONE", 7, None, None, None, "flat_order_event", False)]),
    ('{"order_id":7,"event_type":"COURIER_ASSIGNED","event_message":"the COURIER  42 assigned"}',
     [("COURIER_ASSIGNED", 7, None, 42, None, "flat_order_event", False)]),
    ('{"order_id":7,"event_type":"COURIER_ASSIGNED","courier_id":5,"event_message":"courier 42"}',
     [("COURIER_ASSIGNED", 7, None, 5, None, "flat_order_event", False)]),
    ('{"order_id":12.9,"status":"preparing"}', [("STATUS_CHANGE", 12, "PREPARING", None, None, "status_update", False)]),
    ('{"order_id":"12.5","order_status":"a","status":0}', [("STATUS_CHANGE", None, "A", None, None, "status_update", False)]),
    ('{"order":{"order_id":7,"order_status":"PREPARING","courier_id":3},"timestamp":1780394400}',
     [("STATUS_CHANGE", 7, "PREPARING", 3, None, "nested_order", True)]),
    ('{"order":{"order_id":7,"created_at":"no time"},"timestamp":%s}' % STAMP,
     [("STATUS_CHANGE", 7, None, None, None, "nested_order", False)]),
    ('{"courier_id":3,"is_available":"YES "}', [("COURIER_AVAILABILITY", None, None, 3, True, "courier_availability", False)]),
    ('{"courier_id":3,"is_available":1,"available":"0"}',
     [("COURIER_AVAILABILITY", None, None, 3, False, "courier_availability", False)]),
    ('{"courier_id":3,"is_available":1}', [("COURIER_AVAILABILITY", None, None, 3, None, "courier_availability", False)]),
    ('{"courier_id":3,"lat":-23.5,"lon":-46.6,"order_id":7}', [("COURIER_LOCATION", 7, None, 3, False, "courier_location", False)]),
    ('{"courier_id":3,"latitude":1,"lon":2}', [("COURIER_LOCATION", None, None, 3, None, "courier_location", False)]),
    ('{"zz":1,"aa":2}', [("UNKNOWN", None, None, None, None, "unknown:aa,zz", False)]),
    ("garbage", [("UNKNOWN", None, None, None, None, "unknown:raw_text", False)]),
    ('{"order_id":7} trailing', [("UNKNOWN", None, None, None, None, "unknown:raw_text", False)]),
    ('{"order_id":7}], [', [("UNKNOWN", None, None, None, None, "unknown:raw_text", False)]),
    ('[{"order_id":1,"status":"a"},{"order_id":2,"status":"b"},5,null]',
     [("STATUS_CHANGE", 1, "A", None, None, "status_update", False), ("STATUS_CHANGE", 2, "B", None, None, "status_update", False)]),
    ('{"records":[{"order_id":1,"status":"a"},"x"]}', [("STATUS_CHANGE", 1, "A", None, None, "status_update", False)]),
    ('{"records":7}', [("UNKNOWN", None, None, None, None, "unknown:records", False)]),
    ("[]", []), ("5", []), ("null", []), ("  ", []), ("", []),
]


def _rows(spark, texts, **options):
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, payload string")
    events = N.normalize(frame, **options).orderBy("n", "pos")
    return [
        (r.n, (r.event_type, r.order_id, r.status, r.courier_id, r.courier_available, r.format_name, r.event_ts is not None))
        for r in events.collect()
    ]


def test_rules(spark):
    got = {}
    for n, row in _rows(spark, [c[0] for c in CASES]):
        got.setdefault(n, []).append(row)
    for n, (payload, want) in enumerate(CASES):
        assert got.get(n, []) == want, payload


def test_times(spark):
    texts = [
        '{"order_id":1,"status":"a","created_at":"2026-06-02T10:00:00Z"}',
        '{"order_id":1,"status":"a","created_at":"2026-06-02T12:00:00+02:00"}',
        '{"order_id":1,"status":"a","timestamp":1780394400.0}',
        '{"order_id":1,"status":"a","created_at":"2026","timestamp":1780394400}',
    ]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, payload string")
    times = [r.t for r in N.normalize(frame).orderBy("n").select(F.unix_seconds("event_ts").alias("t")).collect()]
    # a first value that is no time is not replaced by the second
    assert times == [1780394400, 1780394400, 1780394400, None]


def test_glued_frames(spark):
    one, two = '{"order_id":1,"status":"a}{b"}', '{"order_id":2,"status":"c","x":{"y":{}}}'
    rows = _rows(spark, [one + two, one + " " + two + one, one + "junk}", one], split_frames=True)
    assert [(n, r[1]) for n, r in rows] == [(0, 1), (0, 2), (1, 1), (1, 2), (1, 1), (2, None), (3, 1)]
    # without the option such a line is one unreadable text
    assert _rows(spark, [one + two])[0][1][5] == "unknown:raw_text"


def test_binary_payload(spark):
    frame = spark.createDataFrame([(bytearray(b'{"order_id":1,"status":"\xff"}'),)], "payload binary")
    assert N.normalize(frame).first().status == "�"


def test_quarantine(spark):
    frame = spark.createDataFrame([("x",), ('{"a":1}',), ('{"order_id":1,"status":"a"}',)], "payload string")
    good, bad = N.quarantine(N.normalize(frame))
    assert good.count() == 1 and sorted(r.parse_error for r in bad.collect()) == [False, True]


@pytest.mark.parametrize("style, kind", [("legacy", "flat_order_event"), ("v2", "flat_order_event_v2")])
def test_encode_round_trip(spark, style, kind):
    row = (1, 7, "STATUS_CHANGE", None, "PENDING", "m", None, None, "2026-06-02T10:00:00+00:00", None, 1, 2)
    schema = (
        "event_id long, order_id long, event_type string, from_status string, to_status string, event_message string, "
        "latitude double, longitude double, created_at string, courier_id long, client_id long, restaurant_id long"
    )
    sent = N.encode(spark.createDataFrame([row], schema)).where(F.col("style") == style)
    assert sent.first().partition_key == "7"
    back = N.normalize(sent, payload="data").first()
    assert (back.event_type, back.order_id, back.status, back.format_name) == ("ORDER_CREATED", 7, "PENDING", kind)


def test_last_value_of_a_repeated_key_counts(spark):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    row = N.normalize(spark.createDataFrame([('{"order_id":1,"status":"a","status":"b"}',)], "payload string")).first()
    assert (row.status, row.parse_error) == ("B", False)
