"""Readings that arrive after their window has closed, for stored events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gaugeflow.operators.runs import BLOCK
from gaugeflow.schema import WATERMARK, WINDOW


def mark_late(events: DataFrame, watermark: str = WATERMARK, size: str = WINDOW,
              source: str = "partition", block: int = BLOCK) -> DataFrame:
    """Add ``window_end`` and ``late``.

    A reading is late if an earlier arrival of the same source partition was at
    least ``watermark`` past the end of the reading's window. The newest time so
    far is kept per block of arrivals and carried on, so a partition that holds
    most of the data is still read by many tasks.
    """
    keys = [source, "_block"]
    rows = events.withColumn("_block", F.expr(f"seq div {block}"))
    earlier = Window.partitionBy(*keys).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    blocks_before = Window.partitionBy(source).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    carried = rows.groupBy(*keys).agg(F.max("event_time").alias("_newest")).select(
        *keys, F.max("_newest").over(blocks_before).alias("_carried"))
    newest = F.greatest(F.max("event_time").over(earlier), F.col("_carried"))
    return (rows.join(carried, keys)
            .withColumn("_newest", newest)
            .withColumn("window_end", F.window("event_time", size)["end"])
            .withColumn("late", F.coalesce(
                F.col("window_end") <= F.col("_newest") - F.expr(f"INTERVAL {watermark}"),
                F.lit(False)))
            .drop("_block", "_carried", "_newest"))


def split_late(events: DataFrame, watermark: str = WATERMARK, size: str = WINDOW,
               source: str = "partition") -> tuple[DataFrame, DataFrame]:
    """(on time, late)"""
    marked = mark_late(events, watermark, size, source)
    on_time = marked.filter(~F.col("late")).drop("late", "window_end")
    return on_time, marked.filter("late").drop("late")


def late_counts(events: DataFrame, watermark: str = WATERMARK, size: str = WINDOW,
                source: str = "partition") -> DataFrame:
    """Per sensor: readings, and how many of them came too late."""
    return mark_late(events, watermark, size, source).groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("event_count"), F.count_if("late").alias("late_count"))
