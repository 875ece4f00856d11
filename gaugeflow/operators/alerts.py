"""Sustained-threshold alerts over stored events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeflow.operators.cooldown import suppress
from gaugeflow.operators.enrich import mark_breaches
from gaugeflow.operators.runs import BLOCK, breach_runs
from gaugeflow.schema import ALERT, COOLDOWN_MS, MIN_CONSECUTIVE, UNKNOWN_ID
from gaugeflow.sources.metadata import Metadata

ALERT_COLUMNS = ALERT.names
# what a row about a whole run tells of the run's first reading
LASTING = ["value", "threshold", "sensor_type", "location"]


def as_reading(events: DataFrame, metadata: Metadata) -> DataFrame:
    marked = mark_breaches(events, metadata)
    return marked.select(
        "sensor_id", "seq", "event_time", "breach", "value", "threshold", "critical_threshold",
        "severity", "sensor_type", "location", F.col("event_time_text").alias("timestamp"))


def _as_alert(rows: DataFrame, *more) -> DataFrame:
    return rows.withColumns({
        "sensor_type": F.coalesce("sensor_type", F.lit(UNKNOWN_ID)),
        "location": F.coalesce("location", F.lit(UNKNOWN_ID)),
        "event_date": F.to_date("event_time"),
    }).select(*ALERT_COLUMNS, *more)


def sustained_alerts(events: DataFrame, metadata: Metadata,
                     min_consecutive: int = MIN_CONSECUTIVE, cooldown_ms: int = COOLDOWN_MS,
                     block: int = BLOCK, block_ms: int | None = None) -> DataFrame:
    """One row per alert: the breach has lasted ``min_consecutive`` readings, in
    arrival order, and the last alert of the sensor is older than the cooldown, in
    event time. An alert does not end the run."""
    runs = breach_runs(as_reading(events, metadata), min_consecutive, block)
    candidates = runs.withColumn("event_ms", F.unix_millis("event_time"))
    return _as_alert(suppress(candidates, cooldown_ms, block_ms))


def duration_alerts(events: DataFrame, metadata: Metadata, min_duration_s: int,
                    block: int = BLOCK) -> DataFrame:
    """One row per run of breaches: its first reading at least ``min_duration_s``
    seconds of event time after the run's first reading."""
    runs = breach_runs(as_reading(events, metadata), 1, block)
    lasted = F.unix_micros("event_time") - F.unix_micros("run_since")
    long_runs = runs.filter(lasted >= min_duration_s * 1_000_000)
    first = long_runs.groupBy("sensor_id", "run_seq").agg(
        F.min_by(F.struct(*[c for c in long_runs.columns if c not in ("sensor_id", "run_seq")]),
                 "seq").alias("row"))
    return _as_alert(first.select("sensor_id", "run_seq", "row.*"), "run_since")


def lasting_rows(runs: DataFrame, min_duration_s: int) -> DataFrame:
    """Runs as result rows, with the moment at which each had lasted long enough."""
    due = F.timestamp_micros(F.unix_micros("run_since") + F.lit(min_duration_s * 1_000_000))
    return runs.select(
        "sensor_id", "run_seq", "run_since", due.alias("due_time"), "value", "threshold",
        *[F.coalesce(c, F.lit(UNKNOWN_ID)).alias(c) for c in ("sensor_type", "location")],
        F.to_date(due).alias("event_date"))


def lasting_breaches(events: DataFrame, metadata: Metadata, min_duration_s: int,
                     until: Column | None = None, block: int = BLOCK) -> DataFrame:
    """One row per run of breaches that lasts ``min_duration_s`` seconds of event time, with or
    without a breach at its end.

    A value holds until the sensor's next reading in arrival order, so a run lasts from its
    first reading to the one that ends it; a run that nothing has ended lasts until the
    moment ``until`` (a literal), or its newest reading if none is given.
    """
    keys = ["sensor_id", "_block"]
    rows = as_reading(events, metadata).withColumn("_block", F.expr(f"seq div {block}"))
    heads = rows.groupBy(*keys).agg(F.min_by("event_time", "seq").alias("_head"))
    after = heads.select(*keys, F.lead("_head").over(
        Window.partitionBy("sensor_id").orderBy("_block")).alias("_next_head"))
    here = Window.partitionBy(*keys).orderBy("seq")
    held = rows.withColumn("_next", F.lead("event_time").over(here)).join(after, keys).withColumn(
        "_next", F.coalesce("_next", "_next_head")).drop("_block", "_next_head")
    runs = breach_runs(held, 1, block).groupBy("sensor_id", "run_seq", "run_since").agg(
        F.min_by(F.struct(*LASTING), "seq").alias("first"),
        F.max(F.greatest("event_time", "_next")).alias("last"),
        F.bool_or(F.col("_next").isNull()).alias("open"))
    if until is not None:
        runs = runs.withColumn("last", F.when(F.col("open"), F.greatest("last", until)).otherwise(F.col("last")))
    lasted = F.unix_micros("last") - F.unix_micros("run_since")
    return lasting_rows(runs.where(lasted >= min_duration_s * 1_000_000).select(
        "sensor_id", "run_seq", "run_since", "first.*"), min_duration_s)
