"""Tumbling event-time statistics, the same for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeflow.functions.display import clock_label
from gaugeflow.functions.exact_sum import digit_sums, exact_total, with_digits
from gaugeflow.functions.rounding import round_exact
from gaugeflow.schema import UNKNOWN_ID, WINDOW


def window_aggregates(events: DataFrame, size: str = WINDOW, watermark: str | None = None,
                      places: int | None = 2) -> DataFrame:
    """Average, minimum, maximum and count per sensor and tumbling window.

    Type and location are those of the last reading, in arrival order, that
    carries one. Sums are exact, so results do not depend on how rows are dealt.
    Statistics are combined before the shuffle, so a sensor that
    sends most of the data costs each task one row per window. ``watermark``
    bounds the state of a streaming query; late rows are then dropped by Spark.
    """
    return finished_windows(_stream_stats(events, size, watermark) if events.isStreaming
                            else _stats(events, size), places)


def finished_windows(stats: DataFrame, places: int | None = 2) -> DataFrame:
    """The result rows of windows whose statistics are known."""
    def rounded(name):
        return F.col(name) if places is None else round_exact(F.col(name), places).alias(name)

    start, end = F.col("start"), F.col("end")
    return stats.select(
        start.alias("window_start"), end.alias("window_end"),
        clock_label(start).alias("window_start_label"),
        clock_label(end).alias("window_end_label"),
        "sensor_id",
        F.coalesce("sensor_type", F.lit(UNKNOWN_ID)).alias("sensor_type"),
        F.coalesce("location", F.lit(UNKNOWN_ID)).alias("location"),
        rounded("avg_value"), rounded("min_value"), rounded("max_value"), "event_count",
        F.to_date(start).alias("event_date"))


def _numbers():
    return [*digit_sums("value"), F.count("value").alias("numbers"),
            F.min("value").alias("min_value"), F.max("value").alias("max_value"),
            F.count(F.lit(1)).alias("event_count")]


def _average():
    return exact_total("value") / F.nullif(F.col("numbers"), F.lit(0))


def _stats(events: DataFrame, size: str) -> DataFrame:
    """Stored events: numbers are combined by hash per window, sensor, type and location.
    A sensor has few of those per window, so the step that picks the last type and
    location, which Spark can only do by sorting, sees about one row per window."""
    fine = with_digits(events, "value").groupBy(
        F.window("event_time", size)["start"].alias("start"), "sensor_id", "sensor_type",
        "location").agg(*_numbers(), F.max("seq").alias("seq"))
    return fine.groupBy("start", "sensor_id").agg(
        *digit_sums("value"), F.sum("numbers").alias("numbers"), F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"), F.sum("event_count").alias("event_count"),
        *_last_attributes(),
    ).withColumns({"end": F.col("start") + F.expr(f"INTERVAL {size}"), "avg_value": _average()})


def _stream_stats(events: DataFrame, size: str, watermark: str | None) -> DataFrame:
    """A stream aggregates once, by the window struct that carries its watermark."""
    if watermark:
        events = events.withWatermark("event_time", watermark)
    return with_digits(events, "value").groupBy(F.window("event_time", size), "sensor_id").agg(
        *_numbers(), *_last_attributes(),
    ).withColumns({"start": F.col("window.start"), "end": F.col("window.end"),
                   "avg_value": _average()})


def _last_attributes():
    return [F.expr(f"max_by({name}, seq) FILTER (WHERE {name} IS NOT NULL)").alias(name)
            for name in ("sensor_type", "location")]
