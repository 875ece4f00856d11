from data import at, event, events

from gaugeflow.operators.lateness import late_counts, mark_late, split_late
from gaugeflow.operators.windows import window_aggregates


def test_statistics_per_minute(spark):
    rows = [event("a", 0, 5, 1.0), event("a", 1, 59.999, 2.0), event("a", 2, 60, 9.0),
            event("b", 3, 5, 2.675)]
    got = {(r.sensor_id, r.window_start_label): r
           for r in window_aggregates(events(spark, rows)).collect()}
    assert set(got) == {("a", "00:00"), ("a", "00:01"), ("b", "00:00")}
    first = got["a", "00:00"]
    assert (first.avg_value, first.min_value, first.max_value, first.event_count) == (1.5, 1, 2, 2)
    assert (first.window_end_label, str(first.event_date)) == ("00:01", "2024-01-01")
    assert first.window_start == at(0).replace(tzinfo=None)
    assert got["b", "00:00"].avg_value == 2.67  # as Python rounds


def test_attributes_of_the_last_arrival_that_has_them(spark):
    rows = [event("a", 2, 1, 1, "new", None), event("a", 1, 30, 1, "old", "here"),
            event("a", 3, 2, 1, None, None), event("b", 4, 2, 1, None, None)]
    got = {r.sensor_id: (r.sensor_type, r.location)
           for r in window_aggregates(events(spark, rows)).collect()}
    assert got == {"a": ("new", "here"), "b": ("unknown", "unknown")}


def test_labels_do_not_merge_days(spark):
    rows = [event("a", 0, 0, 1), event("a", 1, 86_400, 1)]
    assert window_aggregates(events(spark, rows)).count() == 2


def test_late_readings(spark):
    # the first window closes once a reading at 75 s or later has arrived
    rows = [event("a", i, t, 1) for i, t in enumerate([5, 74.999, 58, 75, 59, 61, 0, 200, 190])]
    for block in (1, 2, 3, 100):
        late = {r.seq for r in mark_late(events(spark, rows), block=block).collect() if r.late}
        assert late == {4, 6}
    on_time, late = split_late(events(spark, rows))
    assert (on_time.count(), late.count()) == (7, 2)
    assert late_counts(events(spark, rows)).first().late_count == 2
