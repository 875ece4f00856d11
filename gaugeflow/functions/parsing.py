"""JSON event text to typed columns: decode, both dialects, defaults, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeflow.schema import UNKNOWN_ID

# ---- Fixed values: field names of the two event dialects, forms of times and numbers ----
REQUIRED = ["sensor_id", "sensor_type", "value", "unit", "location"]
OTHER_NAME = {"event_time": "timestamp", "sensor_type": "type"}
ISO_TIME = (r"^\d{4}-\d{2}-\d{2}"
            r"([T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}:?\d{2})?)?$")
HOUR_ONLY = r"^(.{10}[T ]\d{2})(Z|[+-]\d{2}:?\d{2})?$"
MINUTE_ONLY = r"^(.{10}[T ]\d{2}:\d{2})(Z|[+-]\d{2}:?\d{2})?$"
NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
# ---------------------------------------------------------------------------


def _has(name: str, strict: bool) -> Column:
    here = F.map_contains_key("fields", F.lit(name))
    if strict or name not in OTHER_NAME:
        return here
    return here | F.map_contains_key("fields", F.lit(OTHER_NAME[name]))


def _text(name: str, strict: bool) -> Column:
    here = F.element_at("fields", F.lit(name))
    if strict or name not in OTHER_NAME:
        return here
    return F.coalesce(here, F.element_at("fields", F.lit(OTHER_NAME[name])))


def parse_iso_time(text: Column) -> Column:
    """Instant of an ISO-8601 text, NULL for anything else; naive text is session time.

    An hour alone is that hour's beginning; digits beyond the microsecond are cut off.
    """
    plain = F.regexp_replace(text, r"(\.\d{6})\d+", "$1")
    plain = F.regexp_replace(F.regexp_replace(plain, HOUR_ONLY, "$1:00$2"), MINUTE_ONLY, "$1:00$2")
    return F.when(text.rlike(ISO_TIME), F.try_to_timestamp(plain))


def parse_number(text: Column) -> Column:
    """A decimal number in JSON's form or as text; NULL for names, suffixes and hex forms,
    which Spark's own cast would take."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def last_of_each(fields: Column) -> Column:
    """A decoded map in which the last of several equal names counts."""
    entries = F.map_entries(fields)
    latest = F.filter(entries, lambda e, i: ~F.exists(
        F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
    twice = F.size(F.array_distinct(F.map_keys(fields))) < F.size(fields)
    return F.when(twice, F.map_from_entries(latest)).otherwise(fields)


def _reject_reason(value: Column, strict: bool) -> Column:
    bad_value = value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    reason = F.when(F.col("fields").isNull(), F.lit("bad_json"))
    for name in REQUIRED:
        if not strict:
            reason = reason.when(~_has(name, strict), F.lit(f"missing_{name}"))
        if not strict or name in ("sensor_id", "value"):
            reason = reason.when(_has(name, strict) & _text(name, strict).isNull(),
                                 F.lit(f"null_{name}"))
        if name == "value":
            reason = reason.when(_has(name, strict) & bad_value, F.lit("bad_value"))
    return reason


def parse_events(envelope: DataFrame, strict: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every record of the envelope as one typed row with a ``reject_reason``.

    ``strict=False`` reads both event dialects and rejects incomplete events.
    ``strict=True`` knows only ``event_time``/``sensor_type`` and fills a missing
    sensor or value with ``unknown`` and 0 instead of rejecting it.
    Missing types and locations stay NULL here, because a window takes the last
    reading that carries one; ``fill_defaults`` names them at the output.
    """
    # As a generator's output the map is decoded once; as a plain column the optimizer would
    # copy the decoding into every filter on the columns below.
    decoded = envelope.select(
        "value", F.col("partition"), F.col("offset").alias("seq"),
        F.col("timestamp").alias("record_time"), *keep,
        F.explode_outer(F.array(F.from_json("value", "map<string,string>"))).alias("fields"))
    decoded = decoded.withColumn("fields", last_of_each(F.col("fields")))
    number = parse_number(F.element_at("fields", F.lit("value")))
    sensor = _text("sensor_id", strict)
    if strict:
        number = F.when(_has("value", strict), number).otherwise(F.lit(0.0))
        sensor = F.when(_has("sensor_id", strict), sensor).otherwise(F.lit(UNKNOWN_ID))
    time_text = _text("event_time", strict)
    return decoded.select(
        sensor.alias("sensor_id"),
        F.coalesce(parse_iso_time(time_text), F.col("record_time")).alias("event_time"),
        F.coalesce(time_text, F.lit("")).alias("event_time_text"),
        _text("sensor_type", strict).alias("sensor_type"),
        number.alias("value"),
        F.element_at("fields", F.lit("unit")).alias("unit"),
        F.element_at("fields", F.lit("location")).alias("location"),
        "partition", "seq", *keep,
        _reject_reason(number, strict).alias("reject_reason"),
        F.col("value").alias("raw"))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull()).select(
        "partition", "seq", "reject_reason", "raw")


def ingest_result(parsed: DataFrame) -> DataFrame:
    """Outcome per record, as the ingest call answers it."""
    return parsed.select(
        "partition", "seq", "sensor_id",
        F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected").alias("status"),
        "reject_reason")


def fill_defaults(events: DataFrame) -> DataFrame:
    return events.withColumns({
        name: F.coalesce(F.col(name), F.lit(UNKNOWN_ID))
        for name in ("sensor_id", "sensor_type", "location")})
