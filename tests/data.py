"""Small inputs shared by the tests."""

import json
from datetime import datetime, timedelta, timezone

from gaugeflow.schema import ENVELOPE, SENSORS, THRESHOLDS
from gaugeflow.sources.metadata import Metadata, as_dimension

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds):
    return START + timedelta(seconds=seconds)


def ms(seconds):
    return int(at(seconds).timestamp() * 1000)


def envelope(spark, values, partition=0, first=0):
    rows = [(None, v if isinstance(v, (str, type(None))) else json.dumps(v, ensure_ascii=False),
             "sensor-events", partition, first + i, at(3600)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE)


EVENTS = ("sensor_id string, seq long, event_time timestamp, value double, "
          "sensor_type string, location string, event_time_text string, partition int")


def event(sensor, seq, seconds, value, kind="temperature", place="Hall-A1"):
    return (sensor, seq, at(seconds), float(value), kind, place, at(seconds).isoformat(), 0)


def events(spark, rows):
    return spark.createDataFrame(rows, EVENTS)


def metadata(spark, sensors=()):
    thresholds = [("temperature", 60.0, 70.0)]
    return Metadata(as_dimension(spark.createDataFrame(list(sensors), SENSORS), "sensor_id"),
                    as_dimension(spark.createDataFrame(thresholds, THRESHOLDS), "sensor_type"))
