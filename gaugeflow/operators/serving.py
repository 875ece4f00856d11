"""Questions the dashboard asks of the stored results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from gaugeflow.functions.display import one_decimal
from gaugeflow.operators.enrich import with_unit
from gaugeflow.sources.metadata import Dimension

DIMENSIONS = {"type": "sensor_type", "sensor": "sensor_id", "group": "group_name"}
RECENT_ROWS = 15


def latest_n(rows: DataFrame, limit: int, order: list[str]) -> DataFrame:
    """The newest ``limit`` rows, oldest first."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    newest = rows.orderBy(*[F.desc(c) for c in order]).limit(limit)
    return newest.orderBy(*order)


def distinct_sensors(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_distinct("sensor_id").alias("sensor_count"))


def latest_window(aggs: DataFrame) -> DataFrame:
    return aggs.agg(F.max("window_start").alias("latest_window"))


def events_per_minute(aggs: DataFrame) -> DataFrame:
    """The newest window and its number of events; none and 0 if there is no window."""
    per_window = aggs.groupBy("window_start").agg(F.sum("event_count").alias("events"))
    return per_window.agg(
        F.max("window_start").alias("latest_window"),
        F.coalesce(F.max_by("events", "window_start"), F.lit(0)).alias("events_per_min"))


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count(F.lit(1)).alias("active_alerts"),
                      F.count_if(F.col("severity") == "critical").alias("critical_alerts"))


def dashboard_kpis(aggs: DataFrame, alerts: DataFrame) -> DataFrame:
    """All key figures as one row."""
    parts = [alert_counts(alerts), distinct_sensors(aggs), events_per_minute(aggs)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def _option_rows(aggs: DataFrame, dimension: str, groups: Dimension | None) -> DataFrame:
    """Options with their place: the declared one for groups, none for the others."""
    if dimension == "group":
        return groups.rows.groupBy(F.col("group_name").alias("option")).agg(
            F.min("position").alias("position"))
    return aggs.select(F.col(DIMENSIONS[dimension]).alias("option")).distinct().withColumn(
        "position", F.lit(0))


def option_list(aggs: DataFrame, dimension: str, groups: Dimension | None = None) -> DataFrame:
    """What can be selected in a dimension: groups as declared, the others sorted."""
    return _option_rows(aggs, dimension, groups).orderBy("position", "option").select("option")


def _selected(aggs: DataFrame, dimension: str, groups: Dimension | None,
              selection: str | None) -> str | None:
    """The selection if it is an option, else the first option, in one pass."""
    row = _option_rows(aggs, dimension, groups).agg(
        F.max(F.when(F.col("option") == F.lit(selection), F.col("option"))).alias("wanted"),
        F.min_by("option", F.struct("position", "option")).alias("first")).first()
    return row["wanted"] or row["first"]


def in_group(rows: DataFrame, groups: Dimension, name: str) -> DataFrame:
    """Rows of the sensors in one view group."""
    members = groups.rows.filter(F.col("group_name") == name).select("sensor_id")
    return rows.join(F.broadcast(members) if groups.small else members, "sensor_id", "left_semi")


def by_group(rows: DataFrame, groups: Dimension) -> DataFrame:
    """Rows of all view groups; a sensor in two groups appears in both."""
    members = groups.rows.select("group_name", "sensor_id")
    return rows.join(F.broadcast(members) if groups.small else members, "sensor_id")


def select_rows(aggs: DataFrame, dimension: str, selection: str,
                groups: Dimension | None = None) -> DataFrame:
    if dimension == "group":
        return in_group(aggs, groups, selection)
    return aggs.filter(F.col(DIMENSIONS[dimension]) == selection)


def pivot_by_window(aggs: DataFrame, sensor_ids: list[str],
                    order: str = "window_end") -> DataFrame:
    """One row per window and one column of averages per sensor. Of several rows for
    a sensor and window the last by ``order`` counts. The ids are given, so no extra
    job looks for them."""
    chosen = aggs.filter(F.col("sensor_id").isin(sensor_ids))
    return (chosen.groupBy("window_start").pivot("sensor_id", sensor_ids)
            .agg(F.max_by("avg_value", order)).orderBy("window_start"))


def sensor_series(aggs: DataFrame, sensor_id: str) -> DataFrame:
    return (aggs.filter(F.col("sensor_id") == sensor_id)
            .select("window_start", "avg_value", "min_value", "max_value")
            .orderBy("window_start"))


def recent_table(rows: DataFrame, n: int = RECENT_ROWS, ties: str = "sensor_id") -> DataFrame:
    """The newest windows with one-decimal numbers; rows of one window keep the order of ``ties``."""
    top = rows.orderBy(F.desc("window_start"), F.asc(ties)).limit(n)
    return top.select(
        "window_start", "window_end", "sensor_id", "sensor_type", "location", "event_count",
        *[one_decimal(F.col(c)).alias(c) for c in ("avg_value", "min_value", "max_value")])


def latest_per(aggs: DataFrame, key: str) -> DataFrame:
    """The newest row of each key; the highest sensor id among rows of one window."""
    rest = [c for c in aggs.columns if c != key]
    order = F.struct("window_start", "sensor_id")
    newest = aggs.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("row"))
    return newest.select(key, "row.*")


@dataclass(frozen=True)
class SensorView:
    selection: str | None
    options: DataFrame
    rows: DataFrame
    chart: DataFrame
    table: DataFrame
    sensor_count: DataFrame


def sensor_view(aggs: DataFrame, dimension: str, types: Dimension,
                groups: Dimension | None = None, selection: str | None = None) -> SensorView:
    """Everything the sensor page shows for one selection.

    Without a valid selection the first option is taken. The chart holds the
    avg/min/max of a single sensor, otherwise the average per sensor and window in
    long form; ``pivot_by_window`` makes it wide once the sensors are known.
    The unit is blank for a group, because its sensors may differ in type.
    """
    options = option_list(aggs, dimension, groups)
    current = _selected(aggs, dimension, groups, selection)
    rows = select_rows(aggs, dimension, current, groups)
    table = recent_table(rows)
    table = (table.withColumn("unit", F.lit("")) if dimension == "group"
             else with_unit(table, types).drop("label"))
    if dimension == "sensor":
        chart = sensor_series(aggs, current)
    else:
        chart = rows.select("window_start", "sensor_id", "avg_value").orderBy(
            "window_start", "sensor_id")
    return SensorView(current, options, rows, chart, table, distinct_sensors(rows))
