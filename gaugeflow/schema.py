"""Record schemas and the fixed values every job shares."""

from __future__ import annotations

from pyspark.sql import types as T

# One row per record of the broker; files that stand in for it carry the same columns.
ENVELOPE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

SENSORS = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("sensor_type", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("group", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("warning_threshold", T.DoubleType()),
    T.StructField("critical_threshold", T.DoubleType()),
])

THRESHOLDS = T.StructType([
    T.StructField("sensor_type", T.StringType()),
    T.StructField("warning", T.DoubleType()),
    T.StructField("critical", T.DoubleType()),
])

SENSOR_TYPES = T.StructType([
    T.StructField("sensor_type", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("unit", T.StringType()),
])

GROUPS = T.StructType([
    T.StructField("group_name", T.StringType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("position", T.IntegerType()),
])

METADATA_FILE = T.StructType([
    T.StructField("sensors", T.MapType(T.StringType(), T.StructType([
        f for f in SENSORS.fields if f.name != "sensor_id"]))),
    T.StructField("default_thresholds", T.MapType(T.StringType(), T.StructType([
        f for f in THRESHOLDS.fields if f.name != "sensor_type"]))),
])

AGGREGATE = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("window_start_label", T.StringType()),
    T.StructField("window_end_label", T.StringType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("sensor_type", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("avg_value", T.DoubleType()),
    T.StructField("min_value", T.DoubleType()),
    T.StructField("max_value", T.DoubleType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("event_date", T.DateType()),
])

ALERT = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("sensor_type", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("critical_threshold", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("severity", T.StringType()),
    T.StructField("consecutive_breaches", T.IntegerType()),
    T.StructField("seq", T.LongType()),
    T.StructField("event_date", T.DateType()),
])

# ---- Fixed values ---------------------------------------------------------
EVENTS_TOPIC = "sensor-events"
AGGREGATES_TOPIC = "sensor-aggregates"
ALERTS_TOPIC = "sensor-alerts"

WINDOW = "1 minute"
WATERMARK = "15 seconds"
MIN_CONSECUTIVE = 3
COOLDOWN_MS = 30_000
ARCHIVE_INTERVAL = "60 seconds"

UNKNOWN_ID = "unknown"
UNKNOWN_GROUP = "Unknown"

# sensor type, warning, critical: used when no metadata file exists
DEFAULT_THRESHOLDS = [
    ("temperature", 60.0, 70.0),
    ("pressure", 1050.0, 1080.0),
    ("humidity", 80.0, 90.0),
    ("vibration", 30.0, 40.0),
]

# sensor type, label, unit
TYPE_LABELS = [
    ("temperature", "Temperature", "°C"),
    ("humidity", "Humidity", "%"),
    ("pressure", "Pressure", "hPa"),
    ("vibration", "Vibration", "mm/s"),
]

# view group, members
VIEW_GROUPS = [
    ("Machine 1 – Hall A", ["sensor-temp-0000", "sensor-temp-0001", "sensor-vibr-0006"]),
    ("Machine 2 – Hall B", ["sensor-pres-0002", "sensor-pres-0003", "sensor-vibr-0007"]),
    ("Cold Storage", ["sensor-humi-0004"]),
    ("Server Room", ["sensor-humi-0005"]),
]
# ---------------------------------------------------------------------------
