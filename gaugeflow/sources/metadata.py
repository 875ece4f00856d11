"""Static dimensions: sensors, thresholds, type labels, view groups."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from gaugeflow import schema as S

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class Dimension:
    """A lookup table with its key and whether its size allows a broadcast."""

    rows: DataFrame
    key: str
    small: bool


def as_dimension(rows: DataFrame, key: str, max_rows: int = BROADCAST_ROWS,
                 max_bytes: int = BROADCAST_BYTES, unique: bool = True) -> Dimension:
    """Check rows, bytes and key once; the size check stops at the bound of rows.

    A lookup on a repeated key would multiply facts, so it is an error; bridges say
    ``unique=False``.
    """
    if unique and not rows.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"{key} is not unique in the dimension")
    width = F.length(F.to_json(F.struct(*[F.col(c) for c in rows.columns])))
    count, size = rows.select(width.alias("width")).limit(max_rows + 1).agg(
        F.count(F.lit(1)), F.coalesce(F.sum("width"), F.lit(0))).first()
    return Dimension(rows, key, count <= max_rows and size <= max_bytes)


@dataclass(frozen=True)
class Metadata:
    sensors: Dimension
    thresholds: Dimension


def fixed_rows(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A small constant table the optimizer can read, unlike rows held by Python."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    table = pa.table([pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema)],
                     names=schema.names)
    return spark.createDataFrame(table, schema)


def load_metadata(spark: SparkSession, path: str) -> Metadata:
    """Sensors and per-type thresholds of a metadata file.

    Without the file there are no sensors and the built-in thresholds apply. A
    file that lacks a section gives an empty table for it, not the built-in one.
    """
    try:
        file = spark.read.schema(S.METADATA_FILE).option("multiLine", True).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return Metadata(
            as_dimension(fixed_rows(spark, [], S.SENSORS), "sensor_id"),
            as_dimension(fixed_rows(spark, S.DEFAULT_THRESHOLDS, S.THRESHOLDS), "sensor_type"))
    sensors = file.select(F.explode("sensors").alias("sensor_id", "s")).select("sensor_id", "s.*")
    thresholds = (file.select(F.explode("default_thresholds").alias("sensor_type", "t"))
                  .select("sensor_type", "t.*"))
    return Metadata(as_dimension(sensors, "sensor_id"), as_dimension(thresholds, "sensor_type"))


def sensor_types(spark: SparkSession) -> Dimension:
    return as_dimension(fixed_rows(spark, S.TYPE_LABELS, S.SENSOR_TYPES), "sensor_type")


def view_groups(spark: SparkSession, groups=S.VIEW_GROUPS) -> Dimension:
    """Bridge of view groups and their sensors; a sensor may be in several groups."""
    pairs = [(name, sensor, place) for place, (name, sensors) in enumerate(groups)
             for sensor in sensors]
    return as_dimension(fixed_rows(spark, pairs, S.GROUPS), "sensor_id", unique=False)
