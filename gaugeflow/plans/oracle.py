"""The registered queries as SQL for an independent engine, over the same tables."""

from __future__ import annotations

from gaugeflow.plans import events_adapter as A
from gaugeflow.plans.catalog import (
    DAY_MS, FORM_TIMES, FORM_VALUES, HISTORY, LATE_SIZE, PARTS, PIVOT_IDS, UNBROKEN_COOLDOWN,
    UNBROKEN_FROM, VIEW_GROUP, VIEW_SENSOR, VIEW_TYPE)

_TYPE_ROWS = ", ".join(f"('{t}', {w}::DOUBLE, {c}::DOUBLE)" for t, w, c in A.TYPE_THRESHOLDS)
_UNIT_ROWS = ", ".join(f"('{t}', '{label}', '{unit}')" for t, label, unit in A.TYPE_UNITS)
_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"

EV = f"""ev AS (
  SELECT printf('sensor-%04d', user_id) AS sensor_id, ts AS event_time,
         event_type AS sensor_type, value, 'place-' || user_id % {A.PLACES} AS location,
         event_id AS seq, user_id, {_ISO} AS iso
  FROM events)"""

# the same events in the changed order of arrival
MOVED = EV.replace("event_id AS seq", "(event_id + event_id * 37 % 101) * 1000 "
                   "+ event_id % 1000 AS seq")

# the same events as readings of one sensor without a pause
UNBROKEN = f"""{EV.replace("ev AS", "own AS", 1)},
ev AS (
  SELECT 'hot' AS sensor_id, moment AS event_time, 'click' AS sensor_type, 70.0::DOUBLE AS value,
         location, seq, user_id, strftime(moment, '%Y-%m-%dT%H:%M:%S.%f') AS iso
  FROM (SELECT *, make_timestamp(({UNBROKEN_FROM} + seq * 100000 + seq * 37 % 101 * 1500) * 1000) AS moment
        FROM own))"""

SENSORS = f"""types(sensor_type, warning, critical) AS (VALUES {_TYPE_ROWS}),
sensors AS (
  SELECT printf('sensor-%04d', s_suppkey) AS sensor_id,
         CASE WHEN s_nationkey % 7 <> 0 THEN 'area-' || s_nationkey END AS sensor_group,
         s_name AS description,
         CASE WHEN s_suppkey % 5 = 0 THEN {A.OWN_WARNING}::DOUBLE END AS warning,
         CASE WHEN s_suppkey % 5 = 0 THEN {A.OWN_CRITICAL}::DOUBLE END AS critical
  FROM supplier)"""

MARKED = f"""{SENSORS},
marked AS (
  SELECT ev.*, coalesce(s.warning, t.warning) AS threshold,
         coalesce(s.critical, t.critical) AS critical_threshold,
         coalesce(value >= coalesce(s.warning, t.warning), false) AS breach,
         CASE WHEN value >= coalesce(s.critical, t.critical) THEN 'critical'
              ELSE 'warning' END AS severity
  FROM ev LEFT JOIN sensors s USING (sensor_id) LEFT JOIN types t USING (sensor_type))"""

GROUPS = """grp AS (
  SELECT DISTINCT unnest([n_name, r_name]) AS group_name,
         unnest([n_nationkey, 100 + r_regionkey]) AS place,
         printf('sensor-%04d', s_suppkey) AS sensor_id
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

RUNS = f"""{MARKED},
islands AS (
  SELECT *, sum(CASE WHEN breach THEN 0 ELSE 1 END)
            OVER (PARTITION BY sensor_id ORDER BY seq) AS island FROM marked),
runs AS (
  SELECT *, row_number() OVER w AS consecutive_breaches,
         first_value(seq) OVER w AS run_seq, first_value(event_time) OVER w AS run_since
  FROM islands WHERE breach
  WINDOW w AS (PARTITION BY sensor_id, island ORDER BY seq))"""

ALERT_COLUMNS = """sensor_id, sensor_type, location, value, threshold,
  CASE WHEN critical_threshold IS NULL THEN 'Infinity'::DOUBLE ELSE critical_threshold END
    AS critical_threshold,
  iso AS "timestamp", event_time, severity, consecutive_breaches, seq,
  event_time::DATE AS event_date"""


def _round(x: str, scale: int = 100, tie: str = "base % 2 <> 0") -> str:
    """Rounding of the exact binary value; ``tie`` tells when an exact tie goes up."""
    high = f"(134217729::DOUBLE * {x} - (134217729::DOUBLE * {x} - {x}))"
    scaled = f"{x} * {scale}::DOUBLE"
    return f"""(
    SELECT (base + CASE WHEN beyond > 0 OR (beyond = 0 AND error > 0)
                     OR (beyond = 0 AND error = 0 AND {tie}) THEN 1 ELSE 0 END) / {scale}::DOUBLE
    FROM (SELECT floor({scaled}) AS base, ({scaled} - floor({scaled})) - 0.5::DOUBLE AS beyond,
                 ({high} * {scale}::DOUBLE - {scaled}) + ({x} - {high}) * {scale}::DOUBLE AS error))"""


# The exact sum, rounded once: doubles from 1/256 on are whole multiples of 2^-60. The engine's
# own fsum is not exact when it combines partial sums, and its cast of a HUGEINT rounds twice,
# so the number goes through its digits.
_STEPS = f"{2.0 ** 60:.0f}::DOUBLE"
EXACT_SUM = f"sum((value * {_STEPS})::HUGEINT)::VARCHAR::DOUBLE / {_STEPS}"


def _windows(size: str, name: str = "aggs", source: str = "ev") -> str:
    return f"""{name}_raw AS (
  SELECT time_bucket(INTERVAL '{size}', event_time, TIMESTAMP '1970-01-01') AS window_start,
         sensor_id, arg_max(sensor_type, seq) FILTER (sensor_type IS NOT NULL) AS sensor_type,
         arg_max(location, seq) FILTER (location IS NOT NULL) AS location,
         {EXACT_SUM} / count(value) AS a, min(value) AS lo, max(value) AS hi, count(*) AS event_count
  FROM {source} GROUP BY 1, 2),
{name} AS (
  SELECT window_start, window_start + INTERVAL '{size}' AS window_end,
         strftime(window_start, '%H:%M') AS window_start_label,
         strftime(window_start + INTERVAL '{size}', '%H:%M') AS window_end_label,
         sensor_id, sensor_type, location, {_round('a')} AS avg_value,
         {_round('lo')} AS min_value, {_round('hi')} AS max_value, event_count,
         window_start::DATE AS event_date
  FROM {name}_raw)"""


def _alerts(cooldown_ms: int, events: str = EV) -> str:
    """Alert after alert: the next one is the first later arrival beyond the cooldown."""
    return f"""{events}, {RUNS},
cand AS (
  SELECT sensor_id, seq, epoch_us(event_time) // 1000 AS tms FROM runs
  WHERE consecutive_breaches >= 3),
chain(sensor_id, seq, tms) AS (
  SELECT sensor_id, min(seq), arg_min(tms, seq) FROM cand WHERE tms > {cooldown_ms} GROUP BY 1
  UNION ALL
  SELECT c.sensor_id, min(k.seq), arg_min(k.tms, k.seq)
  FROM chain c JOIN cand k
    ON k.sensor_id = c.sensor_id AND k.seq > c.seq AND k.tms - c.tms > {cooldown_ms}
  GROUP BY c.sensor_id, c.seq),
alerts AS (
  SELECT {ALERT_COLUMNS} FROM runs WHERE (sensor_id, seq) IN (SELECT sensor_id, seq FROM chain))"""


def _with(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n"


_EVENT = ("sensor_id, event_time, sensor_type, value, '°C' AS unit, location, seq")
_TENTHS = ", ".join(f"printf('%.1f', {_round(c, 10, 'true')}) AS {c}"
                    for c in ("avg_value", "min_value", "max_value"))
_PIVOT = ", ".join(f"max(avg_value) FILTER (WHERE sensor_id = '{i}') AS \"{i}\"" for i in PIVOT_IDS)
_REASONS = """CASE sensor_type WHEN 'view' THEN 'missing_unit' WHEN 'error' THEN 'null_value'
  WHEN 'purchase' THEN 'bad_value' WHEN 'signup' THEN 'bad_json' END"""

# value, reason and time of each form; a bad time is the broker's: one second after the event
_OK, _AT = "NULL", "'2024-01-02 03:04:05'"
_VALUE_OUTCOMES = [("1.5", _OK), ("2.5", _OK), ("3.5", _OK), *[("NULL", "'bad_value'")] * 3,
                   ("2.0", _OK), ("-5.0", _OK), *[("NULL", "'bad_value'")] * 2,
                   ("NULL", "'bad_value'")]
_TIME_OUTCOMES = ["'2024-01-02 10:00:00'", "'2024-01-02 08:00:00'", "'2024-01-02 10:11:12.123456'",
                  "'2024-01-02 00:00:00'", "'record'", "'2024-01-02 03:04:00'"]
_FORM_ROWS = ", ".join(
    [f"({i}, {v}::DOUBLE, {r}, {_AT if r == _OK else 'NULL'})"
     for i, (v, r) in enumerate(_VALUE_OUTCOMES)]
    + [f"({len(FORM_VALUES) + i}, 1.5, NULL, {t})" for i, t in enumerate(_TIME_OUTCOMES)])
assert len(_VALUE_OUTCOMES) == len(FORM_VALUES) and len(_TIME_OUTCOMES) == len(FORM_TIMES)

_PAGE_GROUP = """(SELECT group_name FROM grp ORDER BY place LIMIT 1)"""
_MEMBERS = f"sensor_id IN (SELECT sensor_id FROM grp WHERE group_name = {_PAGE_GROUP})"

# the parts in which a stream gets its input; a watermark is that of all earlier parts
_IN_PARTS = f"""numbered AS (
  SELECT *, time_bucket(INTERVAL '{LATE_SIZE}', event_time, TIMESTAMP '1970-01-01')
            + INTERVAL '{LATE_SIZE}' AS window_end, least(floor(seq / 1000 * {PARTS} / ((SELECT max(event_id) FROM events) + 101)), {PARTS - 1}) AS part FROM ev),
marks AS (SELECT part, max(max(event_time)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 - INTERVAL 15 SECOND AS mark FROM numbered GROUP BY part),
parts AS (
  SELECT numbered.*, coalesce(window_end <= date_trunc('milliseconds', mark), false) AS late
  FROM numbered JOIN marks USING (part))"""

ORACLES: dict[str, str] = {
    "parse_events_api": _with(EV) + f"SELECT {_EVENT} FROM ev",
    "dialect_merge": _with(EV) + f"SELECT {_EVENT} FROM ev",
    "dialect_strict": _with(EV) + f"""
      SELECT sensor_id, CASE WHEN known THEN event_time
                             ELSE event_time + INTERVAL 1 SECOND END AS event_time,
             CASE WHEN known THEN sensor_type END AS sensor_type, value, '°C' AS unit, location,
             seq, CASE WHEN known THEN iso || 'Z' ELSE '' END AS event_time_text
      FROM (SELECT *, sensor_type IN ('click', 'view') AS known FROM ev)""",
    "strict_defaults": _with(EV) + """
      SELECT CASE WHEN sensor_type = 'view' THEN 'unknown' ELSE sensor_id END AS sensor_id,
             event_time, sensor_type,
             CASE WHEN sensor_type = 'view' THEN 0 ELSE value END AS value, location, seq
      FROM ev WHERE sensor_type IN ('click', 'view')""",
    "ingest_results": _with(EV) + f"""
      SELECT seq, CASE WHEN sensor_type = 'click' THEN 'accepted' ELSE 'rejected' END AS status,
             {_REASONS} AS reject_reason FROM ev""",
    "invalid_events": """
      SELECT 'missing_sensor_id' AS reject_reason, count(*) AS events FROM events
      WHERE json_type(props) = 'OBJECT' AND json_extract(props, '$.sensor_id') IS NULL""",
    "decode_forms": _with(EV, f"""forms(form, value, reason, moment) AS (VALUES {_FORM_ROWS})""") + """
      SELECT seq, forms.value, reason AS reject_reason,
             CASE WHEN moment = 'record' THEN event_time + INTERVAL 1 SECOND
                  ELSE try_cast(moment AS TIMESTAMP) END AS event_time
      FROM ev JOIN forms ON seq % (SELECT count(*) FROM forms) = form""",
    "enrich_events": _with(EV, SENSORS) + """
      SELECT seq, sensor_id, location, value, coalesce(sensor_group, 'Unknown') AS sensor_group,
             coalesce(description, '') AS description
      FROM ev LEFT JOIN sensors USING (sensor_id)""",
    "thresholds": _with(EV, MARKED) + """
      SELECT seq, sensor_id, sensor_type, threshold, critical_threshold FROM marked""",
    "breaches": _with(EV, MARKED) + """
      SELECT seq, sensor_id, value, threshold, severity FROM marked WHERE breach""",
    "near_thresholds": _with(EV, MARKED) + """
      SELECT seq, sensor_id, value, threshold FROM marked
      WHERE value >= 0.95::DOUBLE * threshold AND value < threshold""",
    "type_units": f"""
      WITH units(sensor_type, label, unit) AS (VALUES {_UNIT_ROWS})
      SELECT event_type AS sensor_type, coalesce(label, '') AS label, coalesce(unit, '') AS unit,
             count(*) AS events
      FROM events LEFT JOIN units ON event_type = sensor_type GROUP BY 1, 2, 3""",
    "window_stats_1m": _with(EV, _windows("1 minute")) + "SELECT * FROM aggs",
    "window_stats_gaps": _with(EV, """gaps AS (
      SELECT sensor_id, event_time, value, seq,
             CASE WHEN seq % 3 = 0 THEN sensor_type END AS sensor_type,
             CASE WHEN seq % 5 = 0 THEN location || '-' || sensor_type
                  END AS location
      FROM ev)""", _windows("1 day", source="gaps")) + """
      SELECT * REPLACE (coalesce(sensor_type, 'unknown') AS sensor_type,
                        coalesce(location, 'unknown') AS location) FROM aggs""",
    "window_stats_1h": _with(EV, _windows("1 hour")) + "SELECT * FROM aggs",
    "window_stats_1d": _with(EV, _windows("1 day")) + "SELECT * FROM aggs",
    # a stream gives the windows that its watermark has closed
    "window_stats_stream": _with(EV, _windows("1 minute")) + """
      SELECT * FROM aggs
      WHERE window_end <= (SELECT max(event_time) - INTERVAL 15 SECOND FROM ev)""",
    "window_stats_stream_1d": _with(EV, _windows("1 day")) + """
      SELECT * FROM aggs
      WHERE window_end <= (SELECT max(event_time) - INTERVAL 15 SECOND FROM ev)""",
    "late_events": _with(MOVED) + """
      SELECT sensor_id, count(*) AS event_count,
             count(*) FILTER (WHERE time_bucket(INTERVAL '1 minute', event_time)
               + INTERVAL '1 minute' <= newest - INTERVAL 15 SECOND) AS late_count
      FROM (SELECT *, max(event_time) OVER (PARTITION BY user_id % 4 ORDER BY seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM ev)
      GROUP BY sensor_id""",
    "window_stats_on_time": _with(MOVED, """on_time AS (
      SELECT * FROM (SELECT *, max(event_time) OVER (PARTITION BY user_id % 4 ORDER BY seq
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM ev)
      WHERE newest IS NULL OR time_bucket(INTERVAL '1 hour', event_time) + INTERVAL '1 hour'
        > newest - INTERVAL 15 SECOND
      ORDER BY user_id, event_time)""", _windows("1 hour", source="on_time"))
        + "SELECT * FROM aggs",
    "stream_late_rows": _with(MOVED, _IN_PARTS) + """
      SELECT sensor_id, seq, event_time, value, sensor_type, location,
             window_end FROM parts WHERE late""",
    "stream_windows_without_late": _with(MOVED, _IN_PARTS, """in_time AS (
      SELECT * FROM parts WHERE NOT late)""", _windows(LATE_SIZE, source="in_time")) + """
      SELECT * FROM aggs
      WHERE window_end <= (SELECT max(event_time) - INTERVAL 15 SECOND FROM ev)""",
    "breach_run_lengths": _with(EV, RUNS) + """
      SELECT sensor_id, seq, value, consecutive_breaches, run_seq, run_since FROM runs
      WHERE consecutive_breaches >= 3""",
    "sustained_alerts_30s": _with(_alerts(30_000), recursive=True) + "SELECT * FROM alerts",
    "sustained_alerts_1d": _with(_alerts(DAY_MS), recursive=True) + "SELECT * FROM alerts",
    "sustained_alerts_disorder": _with(_alerts(DAY_MS, MOVED), recursive=True)
        + "SELECT * FROM alerts",
    "sustained_alerts_unbroken": _with(_alerts(UNBROKEN_COOLDOWN, UNBROKEN), recursive=True)
        + "SELECT * FROM alerts",
    "sustained_alerts_stream": _with(_alerts(30_000), recursive=True) + "SELECT * FROM alerts",
    "sustained_alerts_stream_1d": _with(_alerts(DAY_MS), recursive=True) + "SELECT * FROM alerts",
    "sustained_alerts_hot_stream": f"""
      WITH RECURSIVE {EV}, c AS (
        SELECT *, row_number() OVER (ORDER BY seq) AS n, epoch_us(event_time) // 1000 AS tms FROM ev),
      chain(seq, tms) AS (
        SELECT min(seq), arg_min(tms, seq) FROM c WHERE n >= 3
        UNION ALL
        SELECT min(c.seq), arg_min(c.tms, c.seq) FROM chain JOIN c
          ON c.seq > chain.seq AND c.tms - chain.tms > 30000 GROUP BY chain.seq)
      SELECT 'hot' AS sensor_id, 'click' AS sensor_type, location, 70.0::DOUBLE AS value,
             60.0::DOUBLE AS threshold, 120.0::DOUBLE AS critical_threshold, iso AS "timestamp",
             event_time, 'warning' AS severity, n::INTEGER AS consecutive_breaches, seq,
             event_time::DATE AS event_date
      FROM c WHERE seq IN (SELECT seq FROM chain)""",
    "duration_alerts_1h": _with(EV, RUNS) + f"""
      SELECT {ALERT_COLUMNS}, run_since FROM runs
      WHERE event_time - run_since >= INTERVAL 1 HOUR
      QUALIFY row_number() OVER (PARTITION BY sensor_id, run_seq ORDER BY seq) = 1""",
    "latest_aggregates": _with(EV, _windows("1 minute")) + """
      SELECT * FROM aggs ORDER BY window_start DESC, sensor_id DESC LIMIT 100""",
    "latest_many": _with(EV, _windows("1 minute")) + """
      SELECT * FROM aggs ORDER BY window_start DESC, sensor_id DESC LIMIT 5000""",
    "latest_alerts": _with(_alerts(30_000), recursive=True) + """
      SELECT * FROM alerts ORDER BY seq DESC LIMIT 50""",
    "kpis": _with(_alerts(30_000), _windows("1 minute"), recursive=True) + """
      SELECT (SELECT count(*) FROM alerts) AS active_alerts,
             (SELECT count(*) FROM alerts WHERE severity = 'critical') AS critical_alerts,
             (SELECT count(DISTINCT sensor_id) FROM aggs) AS sensor_count,
             max(window_start) AS latest_window,
             (SELECT sum(event_count)::BIGINT FROM aggs
              WHERE window_start = (SELECT max(window_start) FROM aggs)) AS events_per_min
      FROM aggs""",
    "kpis_by_day": _with(EV, _windows("1 day")) + """
      SELECT window_start AS latest_window, sum(event_count)::BIGINT AS events_per_min
      FROM aggs GROUP BY 1 ORDER BY 1 DESC LIMIT 1""",
    "type_options": "SELECT DISTINCT event_type AS option FROM events ORDER BY 1",
    "sensor_options": _with(EV) + "SELECT DISTINCT sensor_id AS option FROM ev ORDER BY 1",
    "group_options": _with(GROUPS) + """
      SELECT group_name AS option, row_number() OVER (ORDER BY min(place))::INTEGER AS position
      FROM grp GROUP BY 1""",
    "group_view": _with(EV, _windows("1 hour"), GROUPS) + f"""
      SELECT * FROM aggs
      WHERE sensor_id IN (SELECT sensor_id FROM grp WHERE group_name = '{VIEW_GROUP}')""",
    "all_groups_view": _with(EV, _windows("1 day"), GROUPS) + """
      SELECT group_name, count(*) AS windows, sum(event_count)::BIGINT AS events,
             count(DISTINCT sensor_id) AS sensors, max(max_value) AS max_value
      FROM aggs JOIN grp USING (sensor_id) GROUP BY 1""",
    "type_view": _with(EV, _windows("1 hour")) + f"""
      SELECT * FROM aggs WHERE sensor_type = '{VIEW_TYPE}'""",
    "sensor_series": _with(EV, _windows("1 hour")) + f"""
      SELECT window_start, avg_value, min_value, max_value FROM aggs
      WHERE sensor_id = '{VIEW_SENSOR}' ORDER BY 1""",
    "sensor_page": f"""
      WITH {EV}, {_windows("1 hour")}, units(sensor_type, label, unit) AS (VALUES {_UNIT_ROWS}),
      top AS (SELECT * FROM aggs WHERE sensor_type = (SELECT min(sensor_type) FROM aggs)
              ORDER BY window_start DESC, sensor_id LIMIT 15)
      SELECT window_start, window_end, sensor_id, sensor_type, location, event_count,
             {_TENTHS}, coalesce(unit, '') AS unit
      FROM top LEFT JOIN units USING (sensor_type)""",
    "group_page": f"""
      WITH {EV}, {_windows("1 hour")}, {GROUPS},
      top AS (SELECT * FROM aggs WHERE {_MEMBERS} ORDER BY window_start DESC, sensor_id LIMIT 15)
      SELECT window_start, window_end, sensor_id, sensor_type, location, event_count,
             {_TENTHS}, '' AS unit FROM top""",
    "group_page_chart": _with(EV, _windows("1 hour"), GROUPS) + f"""
      SELECT window_start, sensor_id, avg_value FROM aggs WHERE {_MEMBERS}""",
    "group_page_count": _with(EV, _windows("1 hour"), GROUPS) + f"""
      SELECT {_PAGE_GROUP} AS selection, count(DISTINCT sensor_id) AS sensor_count
      FROM aggs WHERE {_MEMBERS}""",
    "one_sensor_page": f"""
      WITH {EV}, {_windows("1 hour")}, units(sensor_type, label, unit) AS (VALUES {_UNIT_ROWS}),
      top AS (SELECT * FROM aggs WHERE sensor_id = '{VIEW_SENSOR}'
              ORDER BY window_start DESC LIMIT 15)
      SELECT window_start, window_end, sensor_id, sensor_type, location, event_count,
             {_TENTHS}, coalesce(unit, '') AS unit
      FROM top LEFT JOIN units USING (sensor_type)""",
    "one_sensor_chart": _with(EV, _windows("1 hour")) + f"""
      SELECT window_start, avg_value, min_value, max_value FROM aggs
      WHERE sensor_id = '{VIEW_SENSOR}'""",
    "pivot_by_window": _with(EV, _windows("1 day")) + f"""
      SELECT window_start, {_PIVOT} FROM aggs
      WHERE sensor_id IN ({", ".join(f"'{i}'" for i in PIVOT_IDS)})
      GROUP BY 1 ORDER BY 1""",
    "recent_table": _with(EV, _windows("1 minute")) + f"""
      SELECT window_start, window_end, sensor_id, sensor_type, location, event_count, {_TENTHS}
      FROM (SELECT * FROM aggs ORDER BY window_start DESC, sensor_id LIMIT 15)""",
    "latest_per_sensor": _with(EV, _windows("1 hour")) + """
      SELECT * FROM aggs
      QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY window_start DESC) = 1""",
    "latest_per_location": _with(EV, _windows("1 hour")) + """
      SELECT * FROM aggs QUALIFY row_number() OVER (
        PARTITION BY location ORDER BY window_start DESC, sensor_id DESC) = 1""",
    "alert_keys": _with(_alerts(DAY_MS), recursive=True) + """
      SELECT seq, sensor_id || '-' || "timestamp" AS alert_key FROM alerts""",
    "publish_roundtrip": _with(EV) + f"SELECT sensor_id AS key, {_EVENT} FROM ev",
    "jsonl_roundtrip": _with(EV) + f"""
      SELECT {_EVENT.replace(", seq", "")}, epoch_us(event_time) AS seq FROM ev""",
    "jsonl_without_time": """
      SELECT without_time, count(*) AS lines,
             CASE WHEN without_time THEN count(*) ELSE count(DISTINCT epoch_us(ts)) END AS numbers
      FROM (SELECT event_type IN ('click', 'view', 'error') AS without_time, ts FROM events)
      GROUP BY without_time""",
    "archive_roundtrip": _with(EV) + """
      SELECT CASE sensor_type
        WHEN 'view' THEN '{"broken' || chr(13) || chr(10) || chr(10) || seq
        WHEN 'error' THEN chr(30) || seq || chr(10)
        WHEN 'signup' THEN NULL
        ELSE printf('{"sensor_id":"%s","event_time":"%s","sensor_type":"%s","value":%s,"unit":"°C","location":"%s","seq":%d,"other":null}',
                    sensor_id, iso, sensor_type, value::VARCHAR, location, seq) END AS line
      FROM ev""",
    "archive_counts": "SELECT count(*) AS events_archived, true AS in_its_folder FROM events",
    "archive_folders": _with(EV) + """
      SELECT seq, strftime(event_time, '%Y') AS year, strftime(event_time, '%m') AS month,
             strftime(event_time, '%d') AS day, strftime(event_time, '%H') AS hour FROM ev""",
    "results_split": _with(_alerts(DAY_MS), _windows("1 hour"), recursive=True) + """
      SELECT 'sensor-aggregates' AS topic, * FROM aggs
      UNION ALL BY NAME
      SELECT 'sensor-alerts' AS topic, * REPLACE (nullif(critical_threshold, 'Infinity'::DOUBLE)
        AS critical_threshold) FROM alerts""",
    "results_rejected": _with(EV) + """
      SELECT seq, CASE sensor_type WHEN 'click' THEN 'not json' WHEN 'view' THEN '[1]' END AS kept
      FROM ev WHERE sensor_type IN ('click', 'view', 'error')
      UNION ALL
      SELECT count(*), 'stored' FROM ev WHERE sensor_type NOT IN ('click', 'view', 'error')""",
    "alerts_history": _with(_alerts(30_000), recursive=True) + f"""
      SELECT * FROM alerts WHERE event_date BETWEEN '{HISTORY[0]}' AND '{HISTORY[1]}'""",
    "stored_latest_aggregates": _with(EV, _windows("1 minute")) + """
      SELECT * FROM aggs ORDER BY window_start DESC, sensor_id DESC LIMIT 5000""",
    "stored_kpis": _with(_alerts(30_000), _windows("1 minute"), recursive=True) + """
      , day AS (SELECT * FROM aggs WHERE event_date = (SELECT max(event_date) FROM aggs)),
      raised AS (SELECT * FROM alerts WHERE event_date = (SELECT max(event_date) FROM alerts))
      SELECT (SELECT count(*) FROM raised) AS active_alerts,
             (SELECT count(*) FROM raised WHERE severity = 'critical') AS critical_alerts,
             count(DISTINCT sensor_id) AS sensor_count, max(window_start) AS latest_window,
             (SELECT sum(event_count)::BIGINT FROM day
              WHERE window_start = (SELECT max(window_start) FROM day)) AS events_per_min
      FROM day""",
    "results_history": _with(EV, _windows("1 hour")) + f"""
      SELECT * FROM aggs WHERE event_date BETWEEN '{HISTORY[0]}' AND '{HISTORY[1]}'""",
}

ORACLES["stored_latest_alerts"] = ORACLES["latest_alerts"]
ORACLES["kpis_from_days"] = ORACLES["kpis"]
ORACLES["lasting_breaches_1h"] = _with(EV, RUNS, """held AS (
  SELECT sensor_id, seq, lead(event_time) OVER (PARTITION BY sensor_id ORDER BY seq) AS next_time FROM marked),
lasting AS (
  SELECT sensor_id, run_seq, run_since,
         max(greatest(event_time, coalesce(next_time, (SELECT max(event_time) - INTERVAL 15 SECOND FROM ev)))) AS last,
         arg_min(value, seq) AS value, arg_min(threshold, seq) AS threshold,
         arg_min(sensor_type, seq) AS sensor_type, arg_min(location, seq) AS location
  FROM runs JOIN held USING (sensor_id, seq) GROUP BY ALL)""") + """
  SELECT sensor_id, run_seq, run_since, run_since + INTERVAL 1 HOUR AS due_time, value, threshold,
         sensor_type, location, (run_since + INTERVAL 1 HOUR)::DATE AS event_date
  FROM lasting WHERE last - run_since >= INTERVAL 1 HOUR"""
ORACLES["lasting_breaches_stream"] = ORACLES["lasting_breaches_1h"]
ORACLES["metadata_file_breaches"] = ORACLES["breaches"]
ORACLES["results_tables_stream"] = ORACLES["results_split"]
ORACLES["archive_compacted"] = ORACLES["archive_roundtrip"].replace(
    "END AS line", "END AS line, strftime(event_time + INTERVAL 1 SECOND, '%Y-%m-%d') AS filed")
ORACLES["latest_per_sensor_stream"] = ORACLES["latest_per_sensor"]
