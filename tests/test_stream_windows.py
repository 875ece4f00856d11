import random
from collections import defaultdict
from math import fsum

import pandas as pd
import pytest

from data import EVENTS, at, event
from gaugeflow.schema import WINDOW
from gaugeflow.streaming.start import few_partitions, finish, query_conf, start_files
from gaugeflow.streaming.windows import (
    BEYOND, DIGITS, LATE, PART, WINDOWS, ClosingWindows, closed_windows, late_readings,
    windows_and_late)


def run(spark, tmp_path, batches, size=WINDOW, **options):
    """The stream is stopped after every batch and goes on from its checkpoint."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in batches:
        spark.createDataFrame(rows, EVENTS).write.mode("append").parquet(source)
        stream = spark.readStream.schema(EVENTS).parquet(source)
        result = windows_and_late(stream, size, buckets=2, **options)
        finish(start_files(result, out, str(tmp_path / "checkpoint"), None, partition="kind",
                           state_partitions=2), 300)
    return spark.read.schema(result.schema).parquet(out)


def model(batches, size=60):
    """Windows and late readings by the rule: late if the watermark of earlier batches has
    reached the end of the window."""
    newest, windows, late = None, defaultdict(list), set()
    for rows in batches:
        mark = None if newest is None else newest - 15
        for sensor, seq, time, value, kind, place, *_ in rows:
            seconds = (time - at(0)).total_seconds()
            end = (seconds // size + 1) * size
            if mark is not None and end <= mark:
                late.add((sensor, seq, end))
            else:
                windows[sensor, end].append((seq, value, kind, place))
        newest = max([(r[2] - at(0)).total_seconds() for r in rows] + ([newest] if newest is not None else []))
    closed = {k: v for k, v in windows.items() if k[1] <= newest - 15}
    return closed, late


def test_late_readings_are_stored(spark, tmp_path):
    batches = [[event("a", 0, 5, 1), event("a", 1, 50, 3)], [event("a", 2, 74.999, 2)],
               [event("a", 3, 58, 5), event("a", 4, 75, 4)], [event("a", 5, 59, 7), event("a", 6, 61, 9)],
               [event("a", 7, 30, 8), event("a", 8, 200, 1), event("b", 9, 10, 1)]]
    rows = run(spark, tmp_path, batches)
    late = {(r.sensor_id, r.seq): r for r in late_readings(rows).collect()}
    # the watermark that closes the first window came with the third batch
    assert set(late) == {("a", 5), ("a", 7), ("b", 9)}
    one = late["a", 7]
    assert (one.value, one.sensor_type, one.location) == (8, "temperature", "Hall-A1")
    assert one.event_time == at(30).replace(tzinfo=None) and one.window_end == at(60).replace(tzinfo=None)
    got = {(r.sensor_id, r.window_start_label): r for r in closed_windows(rows).collect()}
    assert set(got) == {("a", "00:00"), ("a", "00:01")}
    first = got["a", "00:00"]
    assert (first.avg_value, first.min_value, first.max_value, first.event_count) == (3, 1, 5, 3)


@pytest.mark.parametrize("seed", [1])
def test_equals_the_rule_on_random_arrivals(spark, tmp_path, seed):
    rng = random.Random(seed)
    batches, seq = [], 0
    for b in range(4):
        rows = []
        for _ in range(300):
            seq += 1
            rows.append(event(rng.choice("abcde"), seq, max(0, b * 120 + rng.gauss(60, 70)),
                              round(rng.random() * 100, 2), rng.choice(["t", "u", None]), rng.choice(["x", None])))
        batches.append(rows)
    closed, late = model(batches)
    rows = run(spark, tmp_path, batches)
    assert {(r.sensor_id, r.seq, (r.window_end - at(0).replace(tzinfo=None)).total_seconds())
            for r in late_readings(rows).collect()} == late and late
    got = {(r.sensor_id, (r.window_end - at(0).replace(tzinfo=None)).total_seconds()): r
           for r in closed_windows(rows, places=None).collect()}
    assert set(got) == set(closed)
    for key, readings in closed.items():
        row, values = got[key], [v for _, v, _, _ in readings]
        assert row.avg_value == fsum(values) / len(values)
        assert (row.min_value, row.max_value, row.event_count) == (min(values), max(values), len(values))
        for name, place in (("sensor_type", 2), ("location", 3)):
            known = [r for r in readings if r[place] is not None]
            assert row[name] == (max(known)[place] if known else "unknown")


def test_missing_values_and_odd_texts(spark, tmp_path):
    rows = [event("a", 0, 5, 1.0)[:3] + (None,) + event("a", 0, 5, 1.0)[4:],
            event("a\x1e\"", 1, 6, 2.0, None, "line\nbreak")]
    out = run(spark, tmp_path, [rows, [event("z", 2, 500, 1)], rows])
    got = {r.sensor_id: r for r in closed_windows(out).collect()}
    assert (got["a"].avg_value, got["a"].event_count, got["a"].min_value) == (None, 1, None)
    assert {(r.sensor_id, r.value, r.location) for r in late_readings(out).collect()} == {
        ("a", None, "Hall-A1"), ("a\x1e\"", 2.0, "line\nbreak")}
    assert {r.kind for r in out.select("kind").distinct().collect()} == {WINDOWS, LATE}


class _State:
    """One value's state, and the handle and timer values of a call, without a stream."""

    def __init__(self):
        self.row, self.timers = None, []
        self.registerTimer = self.timers.append

    def getValueState(self, *_):
        return self

    def getCurrentWatermarkInMs(self):
        return 0

    def exists(self):
        return self.row is not None

    def get(self):
        return self.row

    def update(self, row):
        self.row = row

    def clear(self):
        self.row = None


def test_a_window_of_many_sensors_is_kept_as_bytes():
    """As objects, a window's sensors cost a Python number per sensor and column and batch."""
    sensors = 50_000

    def part(first, seq):
        names = [f"s{i}" for i in range(first, first + sensors)]
        return pd.DataFrame({
            "bucket": 0, "window_end": 60_000, "sensor_id": names,
            **{n: 1.0 if n == BEYOND else seq for n in (*DIGITS, BEYOND)}, "numbers": 1, "event_count": 1,
            "min_value": float(seq), "max_value": float(seq), "sensor_type_seq": seq,
            "sensor_type": f"t{seq}", "location_seq": [None] * sensors, "location": [None] * sensors,
            "readings": "{}"})[PART.names]

    state, processor = _State(), ClosingWindows()
    processor.init(state)
    for first, seq in ((0, 1), (10_000, 2)):
        assert not list(processor.handleInputRows((0, 60_000), iter([part(first, seq)]), state) or ())
    assert len(state.row) == 1 and isinstance(state.row[0], bytes)
    out, = processor.handleExpiredTimer((0, 60_000), state, None)
    assert not state.exists() and state.timers == [60_000]
    got = out.set_index("sensor_id")
    assert len(got) == 60_000 and (got["event_count"].sum() == 100_000)
    both, first, last = got.loc["s20000"], got.loc["s5"], got.loc["s59999"]
    assert (both["min_value"], both["max_value"], both["sensor_type"], both[DIGITS[0]]) == (1, 2, "t2", 3)
    assert (first["sensor_type"], last["sensor_type"], last["max_value"]) == ("t1", "t2", 2)
    assert got["location"].isna().all()


def test_state_partitions_do_not_grow_with_the_shuffle(spark):
    cores = spark.sparkContext.defaultParallelism
    for shuffle, want in ((2, 2), (100_000, 4 * cores)):
        with query_conf(spark, spark__sql__shuffle__partitions=str(shuffle)):
            assert few_partitions(spark) == want
