"""The driver's tables read as sensor data.

``events`` gives the readings, ``supplier`` the registered sensors (users
without a supplier are unknown sensors), ``nation`` and ``region`` the view
groups a registered sensor belongs to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeflow.schema import SENSOR_TYPES, THRESHOLDS
from gaugeflow.session import use_utc
from gaugeflow.sources.events import BYTES_PER_TRIGGER
from gaugeflow.sources.metadata import Dimension, Metadata, as_dimension, fixed_rows

# ---- Fixed values ---------------------------------------------------------
PLACES = 12
# event type, warning, critical; the type "signup" has none on purpose
TYPE_THRESHOLDS = [("click", 60.0, 120.0), ("view", 50.0, 100.0),
                   ("purchase", 80.0, 150.0), ("error", 30.0, 90.0)]
# event type, label, unit; the type "error" has none on purpose
TYPE_UNITS = [("click", "Click", "ms"), ("view", "View", "s"),
              ("purchase", "Purchase", "EUR"), ("signup", "Signup", "n")]
OWN_WARNING, OWN_CRITICAL = 40.0, 100.0
# ---------------------------------------------------------------------------


def sensor_name(number: Column) -> Column:
    digits = number.cast("string")
    return F.concat(F.lit("sensor-"), F.repeat(F.lit("0"), 4 - F.length(digits)), digits)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def as_sensor_events(events: DataFrame) -> DataFrame:
    """Typed events as ``parse_events`` gives them; works on a stream as well."""
    return events.select(
        sensor_name(F.col("user_id")).alias("sensor_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time_text"),
        F.col("event_type").alias("sensor_type"), "value", F.lit("u").alias("unit"),
        F.concat(F.lit("place-"), (F.col("user_id") % PLACES).cast("string")).alias("location"),
        F.col("user_id").cast("int").alias("partition"), F.col("event_id").alias("seq"))


def sensor_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_sensor_events(table(spark, sf_dir, "events"))


def sensor_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "events")
    stream = (spark.readStream.schema(stored.schema)
              .option("pathGlobFilter", "events.parquet")
              .option("maxBytesPerTrigger", BYTES_PER_TRIGGER).parquet(sf_dir))
    return as_sensor_events(stream)


def as_envelope(events: DataFrame, payload: Column) -> DataFrame:
    """Sensor events as broker records with the given JSON payload. The broker's time
    is one second after the event."""
    return events.select(
        F.col("sensor_id").alias("key"), payload.alias("value"),
        F.lit("sensor-events").alias("topic"), "partition", F.col("seq").alias("offset"),
        (F.col("event_time") + F.expr("INTERVAL 1 SECOND")).alias("timestamp"))


def sensors(spark: SparkSession, sf_dir: str) -> Dimension:
    """Every seventh nation has no group; every fifth sensor has own thresholds."""
    own = F.col("s_suppkey") % 5 == 0
    rows = table(spark, sf_dir, "supplier").select(
        sensor_name(F.col("s_suppkey")).alias("sensor_id"),
        F.lit(None).cast("string").alias("sensor_type"),
        F.lit(None).cast("string").alias("location"),
        F.when(F.col("s_nationkey") % 7 != 0, F.concat(F.lit("area-"), "s_nationkey"))
        .alias("group"),
        F.col("s_name").alias("description"),
        F.when(own, F.lit(OWN_WARNING)).alias("warning_threshold"),
        F.when(own, F.lit(OWN_CRITICAL)).alias("critical_threshold"))
    return as_dimension(rows, "sensor_id")


def metadata(spark: SparkSession, sf_dir: str) -> Metadata:
    thresholds = fixed_rows(spark, TYPE_THRESHOLDS, THRESHOLDS)
    return Metadata(sensors(spark, sf_dir), as_dimension(thresholds, "sensor_type"))


def units(spark: SparkSession) -> Dimension:
    return as_dimension(fixed_rows(spark, TYPE_UNITS, SENSOR_TYPES), "sensor_type")


def groups(spark: SparkSession, sf_dir: str) -> Dimension:
    """A registered sensor is in the group of its nation and in that of its region."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    places = table(spark, sf_dir, "supplier").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = places.select(
        F.explode(F.array(
            F.struct(F.col("n_name").alias("group_name"), F.col("n_nationkey").alias("position")),
            F.struct(F.col("r_name").alias("group_name"), (F.col("r_regionkey") + 100).alias("position")))).alias("g"),
        sensor_name(F.col("s_suppkey")).alias("sensor_id")).select(
        "g.group_name", "sensor_id", F.col("g.position").cast("int").alias("position")).distinct()
    return as_dimension(rows, "sensor_id", unique=False)
