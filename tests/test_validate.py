import json

import pytest
from pyspark.sql import functions as F

from stratus.operators import validate as V
from tests.fixtures import BASE_RECORD


def check_records(spark, records):
    rows = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    return V.check(spark.createDataFrame(rows, "message_id long, value string"))


def verdict(spark, **changes):
    rec = {**BASE_RECORD, **changes}
    return check_records(spark, [rec]).first()


def test_base_record_valid_and_normalised(spark):
    c = check_records(spark, [BASE_RECORD])
    n = V.normalized(c).first()
    assert n["city"] == "Bergen"
    assert n["weather_description"] == "clear night"
    assert n["humidity"] == 58


@pytest.mark.parametrize("field,value,valid", [
    ("temperature", 61.0, False), ("temperature", -81.0, False), ("temperature", 60.0, True),
    ("temperature", -80.0, True), ("humidity", 101, False), ("humidity", -1, False), ("humidity", 100, True),
    ("pressure", 1101, False), ("pressure", 799, False), ("pressure", 800, True),
    ("wind_speed", -1.0, False), ("wind_speed", 0.0, True), ("city", "", False), ("city", "   ", False),
    ("cloudiness", 101, False), ("feels_like", 60.5, False),
    ("temperature", "23.5", True), ("humidity", 65.0, True), ("humidity", 65.5, False),
    ("humidity", "abc", False), ("recorded_at", "not-a-date", False),
    ("city", 123, False), ("country", {"a": 1}, False), ("weather_condition", ["a"], False),
    ("temperature", "23.5f", False), ("temperature", "0x1p3", False), ("recorded_at", "12:30", False),
    ("recorded_at", "2026", True), ("recorded_at", 1700000000, True), ("humidity", True, True), ("humidity", "true", False),
    ("recorded_at", "2026-06-16T10:00:00Z", True), ("recorded_at", "2026-06-16 10:00", True), ("temperature", " 23.5 ", True),
])
def test_rules(spark, field, value, valid):
    assert verdict(spark, **{field: value})["is_valid"] is valid


def test_epoch_times(spark):
    c = check_records(spark, [{**BASE_RECORD, "recorded_at": t} for t in ("2026", 1700000000, 1700000000000)])
    got = [str(r[0]) for r in V.normalized(c).select(F.col("recorded_at").cast("string")).collect()]
    assert got == ["1970-01-01 00:33:46", "2023-11-14 22:13:20", "2023-11-14 22:13:20"]


def test_rounding_to_two_places(spark):
    c = check_records(spark, [{**BASE_RECORD, "temperature": 23.5678}])
    assert V.normalized(c).first()["temperature"] == 23.57


def test_integral_float_becomes_int(spark):
    c = check_records(spark, [{**BASE_RECORD, "humidity": 65.0}])
    assert V.normalized(c).first()["humidity"] == 65


def test_missing_field_and_extra_field(spark):
    rec = {k: v for k, v in BASE_RECORD.items() if k != "visibility"}
    rec["extra"] = 1
    r = check_records(spark, [rec]).first()
    assert not r["is_valid"]
    assert [(e["loc"], e["type"]) for e in r["errors"]] == [("visibility", "missing")]


def test_all_errors_are_listed(spark):
    r = verdict(spark, temperature=999.0, humidity=200)
    assert [e["loc"] for e in r["errors"]] == ["temperature", "humidity"]
    assert all(e["type"] == "value_error" for e in r["errors"])


def test_broken_json_is_invalid_not_fatal(spark):
    r = check_records(spark, ['{"city": "Par']).first()
    assert not r["is_valid"]
    assert len(r["errors"]) == 15


def test_routing_raw_valid_invalid(spark):
    good = BASE_RECORD
    bad = {**BASE_RECORD, "temperature": 999.0, "humidity": 200}
    empty_city = {**BASE_RECORD, "city": ""}
    routed = V.route(check_records(spark, [good, bad, empty_city]), keep=["message_id"]).collect()
    by_topic = {}
    for r in routed:
        by_topic.setdefault(r["topic"], set()).add(r["message_id"])
    assert by_topic[V.TOPIC_RAW] == {0, 1, 2}
    assert by_topic[V.TOPIC_VALID] == {0}
    assert by_topic[V.TOPIC_INVALID] == {1, 2}
    assert not (by_topic[V.TOPIC_VALID] & by_topic[V.TOPIC_INVALID])
    keys = {(r["topic"], r["message_id"]): r["key"] for r in routed}
    assert keys[(V.TOPIC_VALID, 0)] == "bergen"
    valid_value = json.loads([r for r in routed if r["topic"] == V.TOPIC_VALID][0]["value"])
    assert valid_value["city"] == "Bergen"
    invalid_value = json.loads([r for r in routed if r["topic"] == V.TOPIC_INVALID and r["message_id"] == 1][0]["value"])
    assert len(invalid_value["errors"]) == 2


def test_unknown_key_when_city_absent(spark):
    rec = {k: v for k, v in BASE_RECORD.items() if k != "city"}
    c = check_records(spark, [rec])
    assert c.select(V.message_key(c)).first()[0] == "unknown"


def test_decode_runs_once_per_row(spark):
    c = check_records(spark, [BASE_RECORD])
    plan = c.filter(~F.col("is_valid"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
