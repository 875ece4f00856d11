import json
from datetime import datetime

import pytest
from data import at, envelope

from gaugeflow.functions.parsing import accepted, fill_defaults, ingest_result, parse_events, rejected

WHOLE = {"sensor_id": "s1", "event_time": "2024-01-01T00:00:07Z", "sensor_type": "temperature",
         "value": 42.5, "unit": "°C", "location": "Hall-A1"}


def without(*names, **changes):
    return {k: v for k, v in (WHOLE | changes).items() if k not in names}


def reasons(spark, values, strict=False):
    parsed = parse_events(envelope(spark, values), strict)
    return [r.reject_reason for r in parsed.orderBy("seq").collect()]


def one(spark, value, strict=False):
    return parse_events(envelope(spark, [value]), strict).first()


def utc(seconds):
    return at(seconds).replace(tzinfo=None)


def test_numeric_text_is_a_number(spark):
    assert one(spark, without(value="42.5")).value == 42.5


def test_reject_reasons(spark):
    values = [WHOLE, without("value"), without(value=None), without(value="abc"),
              '{"sensor_id":"s","sensor_type":"t","value":NaN,"unit":"u","location":"l"}',
              '{"sensor_id":"s","sensor_type":"t","value":Infinity,"unit":"u","location":"l"}',
              "{bad", "", "[1]", None, without("unit"), without(sensor_id=None)]
    assert reasons(spark, values) == [
        None, "missing_value", "null_value", "bad_value", "bad_value", "bad_value",
        "bad_json", "bad_json", "bad_json", "bad_json", "missing_unit", "null_sensor_id"]


def test_strict_fills_instead_of_rejecting(spark):
    values = [without("value", "sensor_id", "unit", "location"), without(value=None), "{bad"]
    assert reasons(spark, values, strict=True) == [None, "null_value", "bad_json"]
    row = fill_defaults(parse_events(envelope(spark, values[:1]), True)).first()
    assert (row.sensor_id, row.value, row.location) == ("unknown", 0.0, "unknown")


@pytest.mark.parametrize("text", [
    "2024-01-01T00:00:07Z", "2024-01-01T02:00:07+02:00", "2024-01-01T00:00:07",
    "2024-01-01 00:00:07", "2024-01-01T00:00:07.000000+00:00", "2024-01-01T00:00:07.000000999Z"])
def test_forms_of_one_instant(spark, text):
    assert one(spark, without(event_time=text)).event_time == utc(7)


@pytest.mark.parametrize("text", ["2024-01-01T01", "2024-01-01T01:00", "2024-01-01T03+02:00",
                                  "2024-01-01T03:00+0200"])
def test_hours_and_minutes_alone(spark, text):
    assert one(spark, without(event_time=text)).event_time == utc(3600)


@pytest.mark.parametrize("text,value", [("12d", None), ("0x1p3", None), ("1_000", None), (" 4.5 ", 4.5),
                                        ("+1.", 1.0), ("-.5E1", -5.0), ("NaN", None), ("Infinity", None)])
def test_forms_of_numbers(spark, text, value):
    row = one(spark, without(value=text))
    assert row.value == value and row.reject_reason == (None if value else "bad_value")


def test_the_last_of_equal_names_counts(spark):
    text = json.dumps(WHOLE)[:-1] + ',"value":7,"unit":"x","value":8}'
    row = parse_events(envelope(spark, [text])).first()
    assert (row.value, row.unit) == (8.0, "x")


@pytest.mark.parametrize("text", ["bad", "", "12:30", "2024", "2024-01-01T00:00:07 Europe/Berlin",
                                  "2024-13-01T00:00:00Z"])
def test_unreadable_time_takes_the_record_time(spark, text):
    assert one(spark, without(event_time=text)).event_time == utc(3600)


def test_generator_dialect(spark):
    event = {"sensor_id": "s1", "timestamp": "2024-01-01T00:00:05.123456+00:00",
             "type": "temperature", "value": 42.5, "unit": "°C", "location": "Hall-A1"}
    row = one(spark, event)
    assert (row.sensor_type, row.unit, row.reject_reason) == ("temperature", "°C", None)
    assert row.event_time == datetime(2024, 1, 1, 0, 0, 5, 123456)
    strict = one(spark, event, strict=True)
    assert (strict.sensor_type, strict.event_time_text) == (None, "")
    assert strict.event_time == utc(3600)


def test_split_keeps_every_record(spark):
    parsed = parse_events(envelope(spark, [WHOLE, "{bad", without("unit")]))
    assert accepted(parsed).count() == 1
    assert [r.raw for r in rejected(parsed).orderBy("seq").collect()][0] == "{bad"
    outcome = [r.status for r in ingest_result(parsed).orderBy("seq").collect()]
    assert outcome == ["accepted", "rejected", "rejected"]


def test_json_is_decoded_once(spark):
    plan = accepted(parse_events(envelope(spark, [WHOLE])))
    assert plan._jdf.queryExecution().executedPlan().toString().count("from_json") == 1
