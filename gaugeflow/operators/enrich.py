"""Lookups on static dimensions: attributes, thresholds, units, breach and severity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeflow.schema import UNKNOWN_GROUP
from gaugeflow.sources.metadata import Dimension, Metadata

SALTS = 16


def lookup(facts: DataFrame, dim: Dimension, spread: str | None = None) -> DataFrame:
    """Left outer lookup on the dimension's key.

    A dimension of checked size is broadcast, so the facts do not move. A larger
    one is joined by shuffle; stored facts leave a hot key to the adaptive skew
    join. A stream has no such re-planning, so there the dimension is repeated
    once per salt and the facts are spread over the salts by column ``spread``.
    """
    if dim.small:
        return facts.join(F.broadcast(dim.rows), dim.key, "left")
    if not facts.isStreaming or spread is None:
        return facts.join(dim.rows, dim.key, "left")
    salted = dim.rows.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (facts.withColumn("_salt", F.pmod(F.hash(spread), F.lit(SALTS)))
            .join(salted, [dim.key, "_salt"], "left").drop("_salt"))


def enrich(events: DataFrame, sensors: Dimension) -> DataFrame:
    """Add the sensor's group and description, with defaults for unknown sensors."""
    wanted = Dimension(sensors.rows.select("sensor_id", "group", "description"),
                       sensors.key, sensors.small)
    return lookup(events, wanted, spread="seq").withColumns({
        "group": F.coalesce("group", F.lit(UNKNOWN_GROUP)),
        "description": F.coalesce("description", F.lit("")),
    })


def resolve_thresholds(events: DataFrame, metadata: Metadata) -> DataFrame:
    """Add ``threshold`` and ``critical_threshold``.

    Each is the sensor's own value, else the default of the *event's* type, else
    infinity; the two are resolved independently.
    """
    own = metadata.sensors.rows.select(
        "sensor_id", F.col("warning_threshold").alias("_warning"),
        F.col("critical_threshold").alias("_critical"))
    # a sensor without own thresholds resolves like an unknown one
    own = own.filter(F.col("_warning").isNotNull() | F.col("_critical").isNotNull())
    both = lookup(events, Dimension(own, "sensor_id", metadata.sensors.small), spread="seq")
    both = lookup(both, metadata.thresholds, spread="seq")
    infinity = F.lit(float("inf"))
    return both.withColumns({
        "threshold": F.coalesce("_warning", "warning", infinity),
        "critical_threshold": F.coalesce("_critical", "critical", infinity),
    }).drop("_warning", "_critical", "warning", "critical")


def is_breach(value: Column, threshold: Column) -> Column:
    """Inclusive, high side only. Spark ranks NaN above every number, hence the guard."""
    return F.coalesce(~F.isnan(value) & (value >= threshold), F.lit(False))


def severity(value: Column, critical: Column) -> Column:
    return F.when(is_breach(value, critical), "critical").otherwise("warning")


def mark_breaches(events: DataFrame, metadata: Metadata) -> DataFrame:
    """Thresholds, the breach flag and the severity of every reading."""
    return resolve_thresholds(events, metadata).withColumns({
        "breach": is_breach(F.col("value"), F.col("threshold")),
        "severity": severity(F.col("value"), F.col("critical_threshold")),
    })


def near_threshold(events: DataFrame, metadata: Metadata, ratio: float = 0.95) -> DataFrame:
    """Readings just below their warning threshold."""
    near = ((F.col("value") >= F.lit(ratio) * F.col("threshold"))
            & (F.col("value") < F.col("threshold")))
    return resolve_thresholds(events, metadata).filter(near)


def with_unit(rows: DataFrame, types: Dimension) -> DataFrame:
    """Label and unit of the sensor type; blank where the type is unknown."""
    return lookup(rows, types, spread="sensor_id").withColumns({
        "label": F.coalesce("label", F.lit("")), "unit": F.coalesce("unit", F.lit(""))})
