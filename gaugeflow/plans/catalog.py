"""The registered queries: every operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from gaugeflow import schema as S
from gaugeflow.functions.display import alert_key, archive_folder
from gaugeflow.functions.parsing import accepted, ingest_result, parse_events, rejected
from gaugeflow.operators import serving
from gaugeflow.operators.alerts import duration_alerts, lasting_breaches, sustained_alerts
from gaugeflow.operators.enrich import (
    enrich, mark_breaches, near_threshold, resolve_thresholds, with_unit)
from gaugeflow.operators.lateness import late_counts, split_late
from gaugeflow.operators.runs import breach_runs
from gaugeflow.operators.windows import window_aggregates
from gaugeflow.plans import events_adapter as A
from gaugeflow.session import materialize, shared_dir
from gaugeflow.sources import archive, results
from gaugeflow.sources.compaction import compact_archive, read_compacted_hours
from gaugeflow.sources.events import file_events, jsonl_events
from gaugeflow.sources.metadata import load_metadata
from gaugeflow.streaming.aggregates import stream_aggregates
from gaugeflow.streaming.alerts import stream_alerts
from gaugeflow.streaming.durations import stream_lasting_breaches
from gaugeflow.streaming.latest import latest_table, latest_table_job
from gaugeflow.streaming.results import TABLES, result_tables_job
from gaugeflow.streaming.start import few_partitions, finish, start_files
from gaugeflow.streaming.windows import closed_windows, late_readings, windows_and_late

UNBROKEN_FROM, UNBROKEN_COOLDOWN = 1_704_067_200_000, 1_000_003
DAY_MS = 86_400_000
PARTS = 3
LATE_SIZE = "6 hours"
PIVOT_IDS = [f"sensor-{n:04d}" for n in range(8)]
VIEW_GROUP, VIEW_TYPE, VIEW_SENSOR = "ASIA", "click", "sensor-0005"
HISTORY = ("2024-01-10", "2024-01-19")
FORM_VALUES = ['1.5', '"2.5"', '" 3.5 "', '"12d"', '"0x1p3"', '"NaN"', '1,"value":2', '"-.5e1"',
               '"1_000"', 'true', '1e400']
FORM_TIMES = ["2024-01-02T10", "2024-01-02T10+02:00", "2024-01-02T10:11:12.123456789Z",
              "2024-01-02", "10:11", "2024-01-02T03:04"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain_times(fn(A.use_utc(spark), sf_dir))
    QUERIES[fn.__name__] = run
    return fn


def _plain_times(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock time, the type the driver's tables use."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in df.schema.fields])


# ---- payloads of the parsing queries --------------------------------------

def _api_json(**changes: Column) -> Column:
    fields = {
        "sensor_id": F.col("sensor_id"),
        "event_time": F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        "sensor_type": F.col("sensor_type"), "value": F.col("value"),
        "unit": F.lit("°C"), "location": F.col("location")} | changes
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items() if c is not None]),
                     {"ignoreNullFields": "false"})


def _generator_json() -> Column:
    return F.to_json(F.struct(
        "sensor_id",
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
        F.col("sensor_type").alias("type"), "value", F.lit("°C").alias("unit"), "location"))


def _both_dialects() -> Column:
    return F.when(F.col("sensor_type").isin("click", "view"), _api_json()).otherwise(
        _generator_json())


def _damaged_json() -> Column:
    """A different flaw per event type; clicks stay whole."""
    kind = F.col("sensor_type")
    return (F.when(kind == "click", _api_json(value=F.col("value").cast("string")))
            .when(kind == "view", _api_json(unit=None))
            .when(kind == "error", _api_json(value=F.lit(None).cast("double")))
            .when(kind == "purchase", _api_json(value=F.lit("abc")))
            .otherwise(F.substring(_api_json(), 1, 40)))


def _parsed(spark, sf_dir, payload: Column, strict: bool = False) -> DataFrame:
    return parse_events(A.as_envelope(A.sensor_events(spark, sf_dir), payload), strict)


EVENT = ["sensor_id", "event_time", "sensor_type", "value", "unit", "location", "seq"]


@query
def parse_events_api(spark, sf_dir):
    return accepted(_parsed(spark, sf_dir, _api_json())).select(*EVENT)


@query
def dialect_merge(spark, sf_dir):
    return accepted(_parsed(spark, sf_dir, _both_dialects())).select(*EVENT)


@query
def dialect_strict(spark, sf_dir):
    """Only one dialect is known: the others lose type and event time."""
    return accepted(_parsed(spark, sf_dir, _both_dialects(), strict=True)).select(
        *EVENT, "event_time_text")


@query
def strict_defaults(spark, sf_dir):
    """Missing values count as zero, null and bad ones are rejected."""
    payload = F.when(F.col("sensor_type") == "view", _api_json(value=None, sensor_id=None)
                     ).otherwise(_damaged_json())
    return accepted(_parsed(spark, sf_dir, payload, strict=True)).select(
        "sensor_id", "event_time", "sensor_type", "value", "location", "seq")


@query
def ingest_results(spark, sf_dir):
    return ingest_result(_parsed(spark, sf_dir, _damaged_json())).select(
        "seq", "status", "reject_reason")


@query
def invalid_events(spark, sf_dir):
    """The events' own properties taken as payload: none of them is a sensor event."""
    events = A.table(spark, sf_dir, "events")
    envelope = events.select(
        F.col("props").alias("value"), F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))
    return rejected(parse_events(envelope)).groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("events"))


def _forms() -> Column:
    """Forms of numbers and times, one per residue of the arrival number."""
    def event(value: str = "1.5", time: str = "2024-01-02T03:04:05Z") -> str:
        return (f'{{"sensor_id":"s","event_time":"{time}","sensor_type":"t","value":{value},'
                f'"unit":"u","location":"l"}}')
    texts = [event(v) for v in FORM_VALUES] + [event(time=t) for t in FORM_TIMES]
    return F.element_at(F.array(*map(F.lit, texts)),
                        (F.col("seq") % len(texts) + 1).cast("int"))


@query
def decode_forms(spark, sf_dir):
    """What each form of a number or time becomes, or why it is rejected."""
    return _parsed(spark, sf_dir, _forms()).select(
        "seq", "value", "reject_reason",
        F.when(F.col("reject_reason").isNull(), F.col("event_time")).alias("event_time"))


# ---- lookups ---------------------------------------------------------------

@query
def enrich_events(spark, sf_dir):
    return enrich(A.sensor_events(spark, sf_dir), A.sensors(spark, sf_dir)).select(
        "seq", "sensor_id", "location", "value", F.col("group").alias("sensor_group"),
        "description")


@query
def thresholds(spark, sf_dir):
    """Infinity, which means no threshold, is shown as NULL."""
    rows = resolve_thresholds(A.sensor_events(spark, sf_dir), A.metadata(spark, sf_dir))
    infinity = F.lit(float("inf"))
    return rows.select(
        "seq", "sensor_id", "sensor_type",
        F.nullif("threshold", infinity).alias("threshold"),
        F.nullif("critical_threshold", infinity).alias("critical_threshold"))


@query
def breaches(spark, sf_dir):
    return mark_breaches(A.sensor_events(spark, sf_dir), A.metadata(spark, sf_dir)).filter(
        "breach").select("seq", "sensor_id", "value", "threshold", "severity")


def _metadata_files(spark, sf_dir) -> str:
    """Sensors and thresholds as metadata documents, a thousand sensors in each."""
    out, data = shared_dir(spark, "metadata"), A.metadata(spark, sf_dir)

    def section(name: str, rows: DataFrame, key: str, number: Column) -> DataFrame:
        inside = F.struct(*[F.col(c) for c in rows.columns if c != key])
        entries = F.map_from_entries(F.collect_list(F.struct(F.col(key), inside)))
        return rows.groupBy(number.alias("number")).agg(entries.alias(name)).select(
            F.to_json(F.struct(name)).alias("value"))

    thousand = F.floor(F.substring_index("sensor_id", "-", -1).cast("long") / 1000)
    documents = section("sensors", data.sensors.rows, "sensor_id", thousand).unionByName(
        section("default_thresholds", data.thresholds.rows, "sensor_type", F.lit(0)))
    documents.write.option("maxRecordsPerFile", 1).text(out)
    return out


@query
def metadata_file_breaches(spark, sf_dir):
    """Breaches by the thresholds that the metadata files hold."""
    data = load_metadata(spark, _metadata_files(spark, sf_dir))
    return mark_breaches(A.sensor_events(spark, sf_dir), data).filter("breach").select(
        "seq", "sensor_id", "value", "threshold", "severity")


@query
def near_thresholds(spark, sf_dir):
    return near_threshold(A.sensor_events(spark, sf_dir), A.metadata(spark, sf_dir)).select(
        "seq", "sensor_id", "value", "threshold")


@query
def type_units(spark, sf_dir):
    events = A.sensor_events(spark, sf_dir).drop("unit")
    return with_unit(events, A.units(spark)).groupBy("sensor_type", "label", "unit").agg(
        F.count(F.lit(1)).alias("events"))


# ---- windows ---------------------------------------------------------------

def _aggregates(spark, sf_dir, size: str = S.WINDOW) -> DataFrame:
    return window_aggregates(A.sensor_events(spark, sf_dir), size)


@query
def window_stats_1m(spark, sf_dir):
    return _aggregates(spark, sf_dir)


@query
def window_stats_gaps(spark, sf_dir):
    """Most readings carry no type and no place; the last that does names the window."""
    events = A.sensor_events(spark, sf_dir).withColumns({
        "sensor_type": F.when(F.col("seq") % 3 == 0, F.col("sensor_type")),
        "location": F.when(F.col("seq") % 5 == 0, F.concat("location", F.lit("-"), "sensor_type"))})
    return window_aggregates(events, "1 day")


@query
def window_stats_1h(spark, sf_dir):
    return _aggregates(spark, sf_dir, "1 hour")


@query
def window_stats_1d(spark, sf_dir):
    return _aggregates(spark, sf_dir, "1 day")


def _streamed(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Run a stream over all stored input and read its sink."""
    out = shared_dir(spark, name)
    finish(start_files(rows, out, shared_dir(spark, name + "-checkpoint"), interval=None))
    return spark.read.schema(rows.schema).parquet(out)


@query
def window_stats_stream(spark, sf_dir):
    return _streamed(spark, stream_aggregates(A.sensor_event_stream(spark, sf_dir)),
                     "aggregates")


@query
def window_stats_stream_1d(spark, sf_dir):
    return _streamed(spark, stream_aggregates(A.sensor_event_stream(spark, sf_dir), "1 day"),
                     "aggregates")


def _shuffled_arrival(spark, sf_dir) -> DataFrame:
    """The events in another order of arrival, on four source partitions."""
    moved = F.col("seq") + F.col("seq") * 37 % 101
    return A.sensor_events(spark, sf_dir).withColumns({
        "partition": F.col("partition") % 4, "seq": moved * 1000 + F.col("seq") % 1000})


@query
def late_events(spark, sf_dir):
    return late_counts(_shuffled_arrival(spark, sf_dir))


@query
def window_stats_on_time(spark, sf_dir):
    on_time, _ = split_late(_shuffled_arrival(spark, sf_dir), size="1 hour")
    return window_aggregates(on_time, "1 hour")


def _fed_in_parts(spark, rows: DataFrame, number: str, build, name: str, parts: int = PARTS,
                  **how) -> DataFrame:
    """Run a stream over stored rows that come in parts, one micro-batch each, and read its
    sink. The stream ends after each part and goes on from its checkpoint with the next."""
    source, out = shared_dir(spark, name + "-source"), shared_dir(spark, name)
    checkpoint = shared_dir(spark, name + "-checkpoint")
    for part in range(parts):
        rows.where(F.col(number) == part).drop(number).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.drop(number).schema).parquet(source)
        result = build(stream)
        finish(start_files(result, out, checkpoint, interval=None, **how))
    return spark.read.schema(result.schema).parquet(out)


def _in_arrival_parts(spark, sf_dir) -> DataFrame:
    """The events in another order of arrival, cut into parts of about equal size."""
    events = _shuffled_arrival(spark, sf_dir)
    last = A.sensor_events(spark, sf_dir).agg(F.max("seq")).first()[0]
    place = F.floor(F.col("seq") / 1000 * PARTS / ((last or 0) + 101))
    return events.withColumn("part", F.least(place, F.lit(PARTS - 1)).cast("int"))


def _windows_and_late(spark, sf_dir, size: str) -> DataFrame:
    return _fed_in_parts(spark, _in_arrival_parts(spark, sf_dir), "part",
                         lambda events: windows_and_late(events, size, buckets=2), "windows-late",
                         partition="kind", state_partitions=few_partitions(spark))


@query
def stream_late_rows(spark, sf_dir):
    """The readings that came after their window had closed, stored by the stream."""
    return late_readings(_windows_and_late(spark, sf_dir, LATE_SIZE))


@query
def stream_windows_without_late(spark, sf_dir):
    """What the same stream counts: all others, in windows that have closed."""
    return closed_windows(_windows_and_late(spark, sf_dir, LATE_SIZE), LATE_SIZE)


# ---- alerts ----------------------------------------------------------------

@query
def breach_run_lengths(spark, sf_dir):
    marked = mark_breaches(A.sensor_events(spark, sf_dir), A.metadata(spark, sf_dir))
    return breach_runs(marked).select("sensor_id", "seq", "value", "consecutive_breaches",
                                      "run_seq", "run_since")


def _alerts(spark, sf_dir, cooldown_ms: int) -> DataFrame:
    return sustained_alerts(A.sensor_events(spark, sf_dir), A.metadata(spark, sf_dir),
                            cooldown_ms=cooldown_ms)


@query
def sustained_alerts_30s(spark, sf_dir):
    return _alerts(spark, sf_dir, S.COOLDOWN_MS)


@query
def sustained_alerts_1d(spark, sf_dir):
    return _alerts(spark, sf_dir, DAY_MS)


@query
def sustained_alerts_disorder(spark, sf_dir):
    """Runs follow arrival, the cooldown follows event time, and the two differ here."""
    return sustained_alerts(_shuffled_arrival(spark, sf_dir), A.metadata(spark, sf_dir),
                            cooldown_ms=DAY_MS)


@query
def sustained_alerts_unbroken(spark, sf_dir):
    """All events as readings of one sensor that never falls below its threshold nor rests for
    as long as the cooldown, so that every block of time depends on the one before."""
    at = F.timestamp_millis(F.lit(UNBROKEN_FROM) + F.col("seq") * 100_000 + F.col("seq") * 37 % 101 * 1500)
    events = A.sensor_events(spark, sf_dir).withColumns({
        "sensor_id": F.lit("hot"), "sensor_type": F.lit("click"), "value": F.lit(70.0),
        "event_time": at, "event_time_text": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")})
    return sustained_alerts(events, A.metadata(spark, sf_dir), cooldown_ms=UNBROKEN_COOLDOWN)


def _alert_stream(spark, sf_dir, cooldown_ms: int) -> DataFrame:
    rows = stream_alerts(A.sensor_event_stream(spark, sf_dir), A.metadata(spark, sf_dir),
                         cooldown_ms=cooldown_ms)
    return _streamed(spark, rows, "alerts")


@query
def sustained_alerts_stream(spark, sf_dir):
    return _alert_stream(spark, sf_dir, S.COOLDOWN_MS)


@query
def sustained_alerts_stream_1d(spark, sf_dir):
    return _alert_stream(spark, sf_dir, DAY_MS)


@query
def sustained_alerts_hot_stream(spark, sf_dir):
    """All events as readings of one sensor that is always above its threshold."""
    events = A.sensor_event_stream(spark, sf_dir).withColumns({
        "sensor_id": F.lit("hot"), "sensor_type": F.lit("click"), "value": F.lit(70.0)})
    return _streamed(spark, stream_alerts(events, A.metadata(spark, sf_dir)), "alerts")


@query
def duration_alerts_1h(spark, sf_dir):
    return duration_alerts(A.sensor_events(spark, sf_dir), A.metadata(spark, sf_dir), 3600)


@query
def lasting_breaches_1h(spark, sf_dir):
    """Runs that last an hour, the open ones until 15 seconds before the newest event."""
    events = A.sensor_events(spark, sf_dir)
    newest = events.agg(F.max("event_time") - F.expr("INTERVAL 15 SECONDS")).first()[0]
    until = F.lit(newest).cast("timestamp")
    return lasting_breaches(events, A.metadata(spark, sf_dir), 3600, until)


@query
def lasting_breaches_stream(spark, sf_dir):
    """The same from a stream in parts, with timers."""
    events = A.sensor_events(spark, sf_dir)
    last = events.agg(F.max("seq")).first()[0]
    part = F.floor(F.col("seq") * PARTS / ((last or 0) + 1)).cast("int")
    return _fed_in_parts(
        spark, events.withColumn("part", part), "part",
        lambda rows: stream_lasting_breaches(rows, A.metadata(spark, sf_dir), 3600, buckets=8), "lasting")


# ---- serving ---------------------------------------------------------------

@query
def latest_aggregates(spark, sf_dir):
    return serving.latest_n(_aggregates(spark, sf_dir), 100, ["window_start", "sensor_id"])


@query
def latest_many(spark, sf_dir):
    """More rows than a reader usually asks for; all of them come."""
    return serving.latest_n(_aggregates(spark, sf_dir), 5000, ["window_start", "sensor_id"])


@query
def latest_alerts(spark, sf_dir):
    return serving.latest_n(_alerts(spark, sf_dir, S.COOLDOWN_MS), 50, ["seq"])


@query
def kpis(spark, sf_dir):
    return serving.dashboard_kpis(_aggregates(spark, sf_dir),
                                  _alerts(spark, sf_dir, S.COOLDOWN_MS))


@query
def kpis_by_day(spark, sf_dir):
    return serving.events_per_minute(_aggregates(spark, sf_dir, "1 day"))


@query
def type_options(spark, sf_dir):
    return serving.option_list(A.sensor_events(spark, sf_dir), "type")


@query
def sensor_options(spark, sf_dir):
    return serving.option_list(A.sensor_events(spark, sf_dir), "sensor")


@query
def group_options(spark, sf_dir):
    """In the declared order, which the position shows."""
    groups = A.groups(spark, sf_dir)
    places = groups.rows.groupBy(F.col("group_name").alias("option")).agg(F.min("position").alias("place"))
    options = serving.option_list(A.sensor_events(spark, sf_dir), "group", groups).join(places, "option")
    # a list that people choose from: its rows fit one task
    return options.select("option", F.row_number().over(Window.orderBy("place")).alias("position"))


@query
def group_view(spark, sf_dir):
    return serving.in_group(_aggregates(spark, sf_dir, "1 hour"), A.groups(spark, sf_dir),
                            VIEW_GROUP)


@query
def all_groups_view(spark, sf_dir):
    rows = serving.by_group(_aggregates(spark, sf_dir, "1 day"), A.groups(spark, sf_dir))
    return rows.groupBy("group_name").agg(
        F.count(F.lit(1)).alias("windows"), F.sum("event_count").alias("events"),
        F.count_distinct("sensor_id").alias("sensors"), F.max("max_value").alias("max_value"))


@query
def type_view(spark, sf_dir):
    return serving.select_rows(_aggregates(spark, sf_dir, "1 hour"), "type", VIEW_TYPE)


@query
def sensor_series(spark, sf_dir):
    return serving.sensor_series(_aggregates(spark, sf_dir, "1 hour"), VIEW_SENSOR)


@query
def sensor_page(spark, sf_dir):
    """The recent table of the first sensor type, which is what opens by default."""
    view = serving.sensor_view(_aggregates(spark, sf_dir, "1 hour"), "type", A.units(spark))
    return view.table


def _page(spark, sf_dir, dimension: str, selection: str | None = None) -> serving.SensorView:
    return serving.sensor_view(_aggregates(spark, sf_dir, "1 hour"), dimension, A.units(spark),
                               A.groups(spark, sf_dir), selection)


@query
def group_page(spark, sf_dir):
    """The recent table of the first declared group."""
    return _page(spark, sf_dir, "group").table


@query
def group_page_chart(spark, sf_dir):
    return _page(spark, sf_dir, "group").chart


@query
def group_page_count(spark, sf_dir):
    view = _page(spark, sf_dir, "group", "no such group")
    return view.sensor_count.select(F.lit(view.selection).alias("selection"), "sensor_count")


@query
def one_sensor_page(spark, sf_dir):
    return _page(spark, sf_dir, "sensor", VIEW_SENSOR).table


@query
def one_sensor_chart(spark, sf_dir):
    return _page(spark, sf_dir, "sensor", VIEW_SENSOR).chart


@query
def pivot_by_window(spark, sf_dir):
    """The selected sensors side by side."""
    return serving.pivot_by_window(_aggregates(spark, sf_dir, "1 day"), PIVOT_IDS)


@query
def recent_table(spark, sf_dir):
    return serving.recent_table(_aggregates(spark, sf_dir))


@query
def latest_per_sensor(spark, sf_dir):
    return serving.latest_per(_aggregates(spark, sf_dir, "1 hour"), "sensor_id")


@query
def latest_per_sensor_stream(spark, sf_dir):
    """The same as a table that a stream keeps; older rows come after newer ones, too."""
    rows = _aggregates(spark, sf_dir, "1 hour")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("sensor_id", "window_start"), F.lit(PARTS)))
    rows = materialize(rows, "results")
    source, out, checkpoint = (shared_dir(spark, f"latest-{n}") for n in ("source", "table", "checkpoint"))
    for part in range(PARTS):
        rows.where(F.col("part") == part).drop("part").write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.drop("part").schema).parquet(source)
        finish(latest_table_job(stream, "sensor_id", out, checkpoint, interval=None))
    return latest_table(spark, out, stream.schema)


@query
def latest_per_location(spark, sf_dir):
    return serving.latest_per(_aggregates(spark, sf_dir, "1 hour"), "location")


@query
def alert_keys(spark, sf_dir):
    alerts = _alerts(spark, sf_dir, DAY_MS)
    return alerts.select("seq", alert_key(F.lit(None), F.col("sensor_id"), F.col("timestamp"))
                         .alias("alert_key"))


# ---- sources and sinks -----------------------------------------------------

@query
def publish_roundtrip(spark, sf_dir):
    """Events published as keyed records to files, read back as a source and parsed. Files
    have no broker that gives numbers, so these go beside the value."""
    events = A.sensor_events(spark, sf_dir).withColumns({
        "unit": F.lit("°C"), "offset": F.col("seq"), "timestamp": F.col("event_time")})
    out = shared_dir(spark, "published")
    results.write_records(results.publish_events(
        events.drop("event_time_text", "seq"), S.EVENTS_TOPIC,
        envelope=("partition", "offset", "timestamp")), out)
    parsed = accepted(parse_events(file_events(spark, out), keep=("key",)))
    return parsed.select("key", *EVENT)


@query
def jsonl_roundtrip(spark, sf_dir):
    """Events as plain lines, read back through the line source; time is the order."""
    out = shared_dir(spark, "lines")
    A.sensor_events(spark, sf_dir).select(_generator_json().alias("value")).write.text(out)
    return accepted(parse_events(jsonl_events(spark, out))).select(*EVENT)


@query
def jsonl_without_time(spark, sf_dir):
    """Lines without a readable time get numbers of their own: as many as there are lines."""
    out = shared_dir(spark, "lines")
    kind = F.col("sensor_type")
    line = (F.when(kind == "click", F.regexp_replace(_generator_json(), "timestamp", "moment"))
            .when(kind == "view", F.lit('{"broken')).when(kind == "error", F.lit("[1]"))
            .otherwise(_generator_json()))
    A.sensor_events(spark, sf_dir).select(line.alias("value")).write.text(out)
    rows = jsonl_events(spark, out).groupBy((F.col("offset") < 0).alias("without_time")).agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("offset").alias("numbers"))
    return rows


def _archived_line() -> Column:
    """Whole events, broken ones, texts with line breaks and the mark, and missing ones."""
    kind = F.col("sensor_type")
    whole = F.format_string(
        '{"sensor_id":"%s","event_time":"%s","sensor_type":"%s","value":%s,"unit":"°C",'
        '"location":"%s","seq":%d,"other":null}', "sensor_id", "event_time_text", "sensor_type",
        F.col("value").cast("string"), "location", "seq")
    return (F.when(kind == "view", F.concat(F.lit('{"broken\r\n\n'), F.col("seq").cast("string")))
            .when(kind == "error", F.concat(F.lit("\u001e"), F.col("seq").cast("string"), F.lit("\n")))
            .when(kind == "signup", F.lit(None).cast("string")).otherwise(whole))


def _archive(spark, sf_dir) -> str:
    out = shared_dir(spark, "archive")
    records = A.as_envelope(A.sensor_event_stream(spark, sf_dir), _archived_line())
    finish(archive.archive_job(records, out, shared_dir(spark, "archive-checkpoint"),
                               interval=None))
    return out


@query
def archive_roundtrip(spark, sf_dir):
    lines = archive.read_archive(spark, _archive(spark, sf_dir))
    return lines.select(F.col("value").alias("line"))


@query
def archive_counts(spark, sf_dir):
    """Counted anew and from the counts of before, which reads no object twice."""
    out = _archive(spark, sf_dir)
    counted = materialize(archive.count_objects(spark, out), "archive-counts")
    return archive.archive_status(spark, out, counted).select(
        "events_archived", F.col("last_object_key").rlike(archive.HOUR_FOLDER).alias("in_its_folder"))


@query
def archive_compacted(spark, sf_dir):
    """Archived by several micro-batches, filed by day; the closed days compacted in two runs,
    and all texts read from the store and the newest day."""
    source, out, store, checkpoint = (shared_dir(spark, f"archive-{n}") for n in (
        "source", "small", "store", "checkpoint"))
    records = A.as_envelope(A.sensor_events(spark, sf_dir), _archived_line())
    for part in range(PARTS):
        records.where(F.col("offset") % PARTS == part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(records.schema).parquet(source)
        finish(archive.archive_job(stream, out, checkpoint, interval=None,
                                   at=F.date_trunc("day", "timestamp")))
    compact_archive(spark, out, store, until=HISTORY[1].replace("-", "") + "00")
    compact_archive(spark, out, store)
    return read_compacted_hours(spark, out, store).select(
        F.col("value").alias("line"), F.concat_ws("-", "year", "month", "day").alias("filed"))


@query
def archive_folders(spark, sf_dir):
    """Every event lies in the folder of the hour it was archived in."""
    events = A.sensor_events(spark, sf_dir)
    return events.select("seq", *archive_folder(F.col("event_time")))


@query
def results_split(spark, sf_dir):
    """Both results through files of records, one folder per topic, and out again with all
    their columns."""
    out = shared_dir(spark, "topics")
    aggs = results.to_records(_aggregates(spark, sf_dir, "1 hour"), S.AGGREGATES_TOPIC)
    results.write_records(aggs.unionByName(_alert_records(spark, sf_dir)), out)
    by_topic = results.split_by_topic(file_events(spark, out), [S.AGGREGATES_TOPIC, S.ALERTS_TOPIC])
    aggs = results.from_records(by_topic[S.AGGREGATES_TOPIC], S.AGGREGATE)
    alerts = results.from_records(by_topic[S.ALERTS_TOPIC], S.ALERT)
    return aggs.withColumn("topic", F.lit(S.AGGREGATES_TOPIC)).unionByName(
        alerts.withColumn("topic", F.lit(S.ALERTS_TOPIC)), allowMissingColumns=True)


@query
def results_tables_stream(spark, sf_dir):
    """Both result topics as one stream, kept as one table per topic and date."""
    out, tables = shared_dir(spark, "topics"), shared_dir(spark, "tables")
    aggs = results.to_records(_aggregates(spark, sf_dir, "1 hour"), S.AGGREGATES_TOPIC)
    results.write_records(aggs.unionByName(_alert_records(spark, sf_dir)), out)
    for stream in result_tables_job(file_events(spark, out, stream=True), tables,
                                    shared_dir(spark, "tables-checkpoint"), interval=None):
        finish(stream)
    aggs, alerts = (spark.read.schema(schema).parquet(f"{tables}/{topic}").withColumn("topic", F.lit(topic))
                    for topic, schema in TABLES.items())
    return aggs.unionByName(alerts, allowMissingColumns=True)


def _alert_records(spark, sf_dir) -> DataFrame:
    """JSON has no infinity: a sensor without a critical threshold has none in its record."""
    alerts = _alerts(spark, sf_dir, DAY_MS).withColumn(
        "critical_threshold", F.nullif("critical_threshold", F.lit(float("inf"))))
    return results.to_records(alerts, S.ALERTS_TOPIC)


@query
def results_rejected(spark, sf_dir):
    """Records that hold no result are kept apart as they came."""
    events = A.sensor_events(spark, sf_dir)
    kind = F.col("sensor_type")
    value = (F.when(kind == "click", F.lit("not json")).when(kind == "view", F.lit("[1]"))
             .when(kind == "error", F.lit(None).cast("string"))
             .otherwise(F.to_json(F.struct("sensor_id", "value"))))
    records = events.select("seq", value.alias("value"))
    bad = results.rejected_records(records, S.ALERT).select("seq", F.col("value").alias("kept"))
    good = results.from_records(records, S.ALERT).agg(F.count(F.lit(1)).alias("seq")).select(
        "seq", F.lit("stored").alias("kept"))
    return bad.unionByName(good)


@query
def alerts_history(spark, sf_dir):
    """Alerts stored by date, then some of the dates read back."""
    out = shared_dir(spark, "alerts")
    results.write_results(_alerts(spark, sf_dir, S.COOLDOWN_MS), out)
    return results.history(spark, out, *HISTORY)


def _stored(spark, sf_dir) -> tuple[str, str]:
    aggs, alerts = shared_dir(spark, "aggregates"), shared_dir(spark, "alerts")
    results.write_results(_aggregates(spark, sf_dir), aggs)
    results.write_results(_alerts(spark, sf_dir, S.COOLDOWN_MS), alerts)
    return aggs, alerts


@query
def stored_latest_aggregates(spark, sf_dir):
    """The newest rows of the stored table, from as many of its newest dates as hold them."""
    aggs, _ = _stored(spark, sf_dir)
    return results.stored_latest(spark, aggs, 5000, ["window_start", "sensor_id"])


@query
def stored_latest_alerts(spark, sf_dir):
    """The newest alerts of the stored table; older dates are not opened."""
    _, alerts = _stored(spark, sf_dir)
    return results.stored_latest(spark, alerts, 50, ["seq"])


@query
def kpis_from_days(spark, sf_dir):
    """Key figures over all dates, merged from one stored row per date."""
    aggs, alerts = _stored(spark, sf_dir)
    days = shared_dir(spark, "day-figures")
    results.write_results(results.day_figures(spark.read.parquet(aggs), spark.read.parquet(alerts)), days)
    return results.merged_figures(spark.read.parquet(days))


@query
def stored_kpis(spark, sf_dir):
    """Key figures of the newest date, read from its folder alone."""
    aggs, alerts = _stored(spark, sf_dir)
    return serving.dashboard_kpis(results.newest_dates(spark, aggs),
                                  results.newest_dates(spark, alerts))


@query
def results_history(spark, sf_dir):
    """Hourly results stored by date, then some of the dates read back."""
    out = shared_dir(spark, "history")
    results.write_results(_aggregates(spark, sf_dir, "1 hour"), out)
    return results.history(spark, out, *HISTORY)
