import pytest

from gaugeflow.operators import serving
from gaugeflow.operators.enrich import enrich, lookup, with_unit
from gaugeflow.schema import AGGREGATE, ALERT, SENSORS
from gaugeflow.sources.metadata import as_dimension, sensor_types, view_groups
from datetime import date
from data import at, event, events


def agg(minute, sensor="sensor-temp-0000", kind="temperature", avg=1013.25, n=10, day=0):
    start = at(day * 86_400 + minute * 60)
    return (start, at(day * 86_400 + minute * 60 + 60), start.strftime("%H:%M"), "", sensor, kind,
            "Hall", avg, avg - 1, avg + 1, n, date(2024, 1, 1 + day))


def aggs(spark, rows):
    return spark.createDataFrame(rows, AGGREGATE)


def alert(seq, severity="warning"):
    return ("a", "t", "l", 1.0, 1.0, 2.0, "", at(seq), severity, 3, seq, date(2024, 1, 1))


def test_latest_n(spark):
    rows = spark.range(2000).withColumnRenamed("id", "seq")
    ids = [r.seq for r in serving.latest_n(rows, 3, ["seq"]).collect()]
    assert ids == [1997, 1998, 1999]
    assert serving.latest_n(rows, 1501, ["seq"]).count() == 1501
    for bad in (0, -1):
        with pytest.raises(ValueError):
            serving.latest_n(rows, bad, ["seq"])


def test_key_figures_across_midnight(spark):
    table = aggs(spark, [agg(23 * 60 + 59, n=7), agg(0, n=5, day=1),
                         agg(0, "sensor-humi-0004", "humidity", n=6, day=1)])
    alerts = spark.createDataFrame([alert(1), alert(2, "critical")], ALERT)
    row = serving.dashboard_kpis(table, alerts).first()
    assert (row.active_alerts, row.critical_alerts, row.sensor_count) == (2, 1, 2)
    assert (row.events_per_min, row.latest_window.day) == (11, 2)


def test_key_figures_of_nothing(spark):
    row = serving.dashboard_kpis(aggs(spark, []), spark.createDataFrame([], ALERT)).first()
    assert (row.active_alerts, row.sensor_count, row.events_per_min) == (0, 0, 0)


def test_groups(spark):
    bridge = view_groups(spark, [("one", ["a", "b"]), ("two", ["b"])])
    table = aggs(spark, [agg(0, "a"), agg(0, "b"), agg(0, "c")])
    assert serving.in_group(table, bridge, "one").count() == 2
    assert serving.in_group(table, bridge, "no such group").count() == 0
    pairs = {(r.group_name, r.sensor_id) for r in serving.by_group(table, bridge).collect()}
    assert pairs == {("one", "a"), ("one", "b"), ("two", "b")}
    assert view_groups(spark).rows.count() == 8


def test_pivot(spark):
    table = aggs(spark, [agg(0, "a", avg=1.0), agg(0, "b", avg=2.0), agg(1, "a", avg=3.0)])
    got = [tuple(r)[1:] for r in serving.pivot_by_window(table, ["a", "b"]).collect()]
    assert got == [(1.0, 2.0), (3.0, None)]


def test_recent_table(spark):
    table = aggs(spark, [agg(m, s) for m in range(10) for s in ("a", "b")])
    rows = serving.recent_table(table).collect()
    assert len(rows) == 15
    assert [(r.window_start.minute, r.sensor_id) for r in rows[:3]] == [(9, "a"), (9, "b"), (8, "a")]
    assert rows[0].avg_value == "1013.3"


def test_sensor_view(spark):
    table = aggs(spark, [agg(m, s, k) for m in range(3) for s, k in
                         (("sensor-temp-0000", "temperature"), ("sensor-humi-0004", "humidity"))])
    types, groups = sensor_types(spark), view_groups(spark)
    view = serving.sensor_view(table, "type", types)
    assert view.selection == "humidity"
    assert {r.unit for r in view.table.collect()} == {"%"}
    view = serving.sensor_view(table, "type", types, selection="no such type")
    assert view.selection == "humidity"
    view = serving.sensor_view(table, "sensor", types, selection="sensor-temp-0000")
    assert view.chart.columns == ["window_start", "avg_value", "min_value", "max_value"]
    assert view.chart.count() == 3 and view.sensor_count.first().sensor_count == 1
    view = serving.sensor_view(table, "group", types, groups, "Cold Storage")
    assert {(r.sensor_id, r.unit) for r in view.table.collect()} == {("sensor-humi-0004", "")}
    view = serving.sensor_view(table, "group", types, groups)
    assert view.selection == "Machine 1 – Hall A"  # the first one declared
    assert [r.option for r in view.options.collect()] == [
        "Machine 1 – Hall A", "Machine 2 – Hall B", "Cold Storage", "Server Room"]
    assert serving.sensor_view(aggs(spark, []), "sensor", types).selection is None


def test_latest_per(spark):
    table = aggs(spark, [agg(0, "a", avg=1.0), agg(1, "a", avg=2.0), agg(1, "b", avg=3.0)])
    assert {r.sensor_id: r.avg_value for r in serving.latest_per(table, "sensor_id").collect()} == {
        "a": 2.0, "b": 3.0}
    assert serving.latest_per(table, "location").first().sensor_id == "b"


def test_units(spark):
    table = spark.createDataFrame([("temperature",), ("odd",), (None,)], "sensor_type string")
    got = {r.sensor_type: r.unit for r in with_unit(table, sensor_types(spark)).collect()}
    assert got == {"temperature": "°C", "odd": "", None: ""}


def test_enrich_defaults(spark):
    sensors = [("a", None, None, "g", None, None, None), ("b", None, None, None, "d", None, None)]
    dim = as_dimension(spark.createDataFrame(sensors, SENSORS), "sensor_id")
    rows = events(spark, [event(s, i, 0, 1) for i, s in enumerate("abc")])
    got = {r.sensor_id: (r.group, r.description) for r in enrich(rows, dim).collect()}
    assert got == {"a": ("g", ""), "b": ("Unknown", "d"), "c": ("Unknown", "")}


def test_dimensions_are_checked(spark):
    rows = spark.createDataFrame([("a", "x" * 500), ("b", "y")], "sensor_id string, note string")
    assert as_dimension(rows, "sensor_id").small
    assert not as_dimension(rows, "sensor_id", max_bytes=400).small
    with pytest.raises(ValueError):
        as_dimension(rows.union(rows), "sensor_id")
    assert as_dimension(rows.union(rows), "sensor_id", unique=False).small


def test_large_dimension_is_not_broadcast(spark):
    dim = as_dimension(spark.createDataFrame([(f"s{i}", i) for i in range(50)],
                                             "sensor_id string, n int"), "sensor_id", max_rows=10)
    assert not dim.small
    facts = events(spark, [event(f"s{i % 60}", i, 0, 1) for i in range(300)])
    joined = lookup(facts, dim, spread="seq")
    assert joined.count() == 300
    assert joined.filter("n is null").count() == 50
